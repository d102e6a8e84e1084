import random
from datetime import datetime

import numpy as np

from inkfall.llm import consensus, leakage, scan_repair

L = consensus.LABELS


def test_consensus_finds_bad_sources(spark):
    rng = random.Random(4)
    good, bad = {f"g{i}": 0.85 for i in range(5)}, {f"b{i}": 0.25 for i in range(5)}
    rows, truth = [], {}
    for i in range(1500):
        t = rng.randrange(4)
        truth[i] = L[t]
        for s, p in rng.sample(sorted((good | bad).items()), 6):
            rows.append((i, s, L[t] if rng.random() < p else "low"))
    df = spark.createDataFrame(rows, "item bigint, source string, label string")
    out, sources = consensus.fit_consensus(df, ["item"])
    got = {r.item: r for r in out.collect()}
    right = sum(got[i].label == t for i, t in truth.items()) / len(truth)
    votes = {}
    for i, _, lab in rows:
        votes.setdefault(i, []).append(lab)
    majority = sum(max(set(v), key=v.count) == truth[i] for i, v in votes.items()) / len(truth)
    assert right > majority + 0.1 and right > 0.85
    rel = {r.source: r.reliability for r in sources.collect()}
    assert min(rel[s] for s in good) > max(rel[s] for s in bad)
    for i, v in list(votes.items())[:200]:
        pairs = [(a == b) for x, a in enumerate(v) for y, b in enumerate(v) if x != y]
        assert abs(got[i].agreement - np.mean(pairs)) < 1e-9 and got[i].disagreed == (len(set(v)) > 1)


def test_blocks_and_kinds_of_join_change_nothing(spark, monkeypatch):
    rows = [(i, f"s{j}", L[(i + (j == 4)) % 4]) for i in range(40) for j in range(5)]
    df = spark.createDataFrame(rows, "item bigint, source string, label string")
    one = {r.item: r.label for r in consensus.fit_consensus(df, ["item"], rounds=2)[0].collect()}
    monkeypatch.setattr(consensus, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(consensus, "BLOCK", 7)
    two = {r.item: r.label for r in consensus.fit_consensus(df, ["item"], rounds=2)[0].collect()}
    assert one == two == {i: L[i % 4] for i in range(40)}


def test_ratings(spark):
    a, b = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(1, "P", "x", ' Some_concerns\n', a), (2, "P", "x", '{"label": "HIGH"}', b), (3, "P", "x", "", datetime(2024, 1, 3)), (4, "P", "y", "[]", a), (5, None, "y", "low", a), (2, "P", "x", '{"label": "HIGH"}', b), (6, "P", "z", None, a)]
    df = spark.createDataFrame(rows, "candidate_id bigint, paper_id string, source string, payload string, rated_at timestamp")
    rated = consensus.latest_ratings(df, ["paper_id"])
    assert [tuple(r) for r in rated.collect()] == [("P", "x", "high")]
    out, sources = consensus.fit_consensus(rated.limit(0), ["paper_id"], rounds=1)
    assert out.count() == 0 and sources.count() == 0


def brute(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return row


def test_myers_equals_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        p, t = ([rng.randrange(5) for _ in range(rng.randrange(1, n))] for n in (40, 60))
        assert leakage.myers(p, t) == brute(p, t)


def test_leaks(spark):
    rng = random.Random(2)
    words = [f"w{i}x" for i in range(400)]
    items = {i: rng.sample(words, 60) for i in range(8)}
    filler = lambda n: [f"f{rng.randrange(9999)}" for _ in range(n)]
    docs = {
        1: filler(50) + items[1] + filler(20),
        2: filler(30) + items[2][10:36] + filler(9),
        3: items[3][:14] + filler(40) + items[3][14:40],
        4: [w for k, w in enumerate(items[4]) for w in ([w, "(sic)"] if k % 12 == 5 else [w])],
        5: filler(9) + items[5][:12] + filler(9),
        6: rng.sample(items[6], 60),
        7: items[7][:9] + ["other"] + items[7][10:20] + ["another"] + items[7][21:34],
    }
    rows = [(d, ", ".join(w).upper(), "z") for d, w in docs.items()] + [(8, None, "z"), (9, "", "z"), (1, ", ".join(docs[1]).upper(), "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    ev = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(90, None), (91, "")], "item_id bigint, passage string")
    got = sorted((r.doc_id, r.item_id) for r in leakage.find_leaks(df, ev).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (7, 7)]
    texts = df.selectExpr("concat('d', doc_id) as doc_id", "text"), ev.selectExpr("concat('i', item_id) as item_id", "passage")
    for least in (True, False):
        assert sorted((r.doc_id, r.item_id) for r in leakage.find_leaks(*texts, least=least).collect()) == [(f"d{d}", f"i{i}") for d, i in got]
    assert leakage.find_leaks(df.limit(0), ev).count() == 0 and leakage.find_leaks(df, ev.limit(0)).count() == 0


def distance(a, b):
    return brute_full(a, b)


def brute_full(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automata_find_all_near_words():
    rng = random.Random(3)
    vocabulary = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in range(400)})
    trie = scan_repair.Trie([(w, 1) for w in vocabulary])
    for k in (1, 2):
        auto = scan_repair.Automata(k)
        for _ in range(60):
            w = "".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9)))
            assert sorted((c, d) for c, _, d in trie.near(w, auto)) == sorted((c, d) for c in vocabulary if (d := distance(w, c)) <= k)


def all_readings(word):
    """Every text that misreadings turn into ``word``, with their least number, by trying them all."""
    out = {("", 0): 0}
    best = {}
    for (text, i), n in iter_states(out, word):
        if i == len(word):
            best[text] = min(best.get(text, 99), n)
    return best


def iter_states(out, word):
    stack = list(out.items())
    while stack:
        (text, i), n = stack.pop()
        yield (text, i), n
        if i < len(word):
            stack.append(((text + word[i], i + 1), n))
            for pairs in scan_repair._by_letter().values():
                stack += [((text + b, i + len(a)), n + 1) for a, b in pairs if word.startswith(a, i)]


def test_readings_are_complete():
    rng = random.Random(5)
    for _ in range(40):
        word = "".join(rng.choice("ceoltir1nmx") for _ in range(rng.randrange(1, 7)))
        every = all_readings(word)
        some = rng.sample(sorted(every), min(len(every), 30)) + ["zz", word + "z"]
        trie = scan_repair.Trie([(w, 1) for w in some])
        assert {w: n for w, (_, n) in trie.readings(word).items()} == {w: every[w] for w in some if w in every}


def test_shards_and_blocks_lose_nothing(spark, monkeypatch):
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("celotm") for _ in range(rng.randrange(1, 7))) for _ in range(1500)})
    vocabulary = spark.createDataFrame([(w, 500) for w in words], "w string, n bigint")
    asked = spark.createDataFrame([(w, 1 + k % 5, k % 2 == 0) for k, w in enumerate(words[::7] + ["e", "rn", "x" * 80, "dlln"])], "w string, n bigint, fresh boolean").dropDuplicates(["w"])
    one, many = (sorted(map(tuple, scan_repair.candidates(asked, vocabulary, size, block).collect())) for size, block in ((1000, 1000), (40, 5)))
    assert one == many and len(one) > 100
    monkeypatch.setattr(scan_repair, "PREFIXES", 12)
    assert sorted(map(tuple, scan_repair.candidates(asked, vocabulary, 40, 5).collect())) == one
    assert scan_repair.candidates(asked, vocabulary.limit(0)).count() == 0 and scan_repair.candidates(asked.limit(0), vocabulary).count() == 0


def test_numbers():
    for word, want in (("2O14", "2014"), ("l2.S", "12.5"), ("1O,OOO", "10,000"), ("12", None), ("lO", None), ("1..O", None), ("1O.", None), ("3O/l2", "30/12"), ("1x", None)):
        assert scan_repair.number_reading(word) == want


def test_words_without_hyphens_and_pages_without_text(spark):
    known = "Data were extracted with a form. Patients were excluded early. The whole of it. They were included again. " * 3
    pages = [(1, "P", 0, "the data were ext\nracted with a form and patients were in\ncluded early for ex"), *[(k, "P", k - 1, " ") for k in range(2, 8)], (8, "P", 7, "cluded were the others with a form"), (9, "Q", 2500, "in the year the data were in-"), (10, "Q", 4999, "cluded with a form again"), (11, "R", 0, "of the\nwhole data")]
    scans = spark.createDataFrame(pages, "page_id bigint, paper_id string, page_index int, text string")
    repair = scan_repair.examine(scans, spark.createDataFrame([(known,)], "text string"))
    got = {(r.page_id, r.line_no, r.word) for r in scan_repair.found(repair).collect() if r.kind == "break"}
    assert got == {(1, 1, "extracted"), (1, 2, "included"), (1, 3, "excluded"), (9, 1, "included")}
    texts = {r.page_id: r.text for r in scan_repair.reflowed(repair).collect()}
    assert texts[1] == "the data were extracted with a form and patients were included early for excluded" and texts[8] == "were the others with a form" and texts[10] == "with a form again"


def test_explained():
    assert scan_repair.explained("measurernents", "measurements") == 1
    assert scan_repair.explained("induded", "included") == 1
    assert scan_repair.explained("cenfrc", "centre") == 2
    assert scan_repair.explained("centre", "center") is None
    assert scan_repair.number_reading("20I1") == "2011" and scan_repair.number_reading("H1N1") is None


def test_scanned_pages(spark):
    clean = spark.createDataFrame([("measurements were repeated by long-term technicians between the two groups before treatment",)] * 30, "text string")
    one = "ACTA TEST, Vol. 1\nmeasurernents were repeated by tech-\nnicians betwcen the two groups before long-\nterm measurements were repeated be-\n12"
    two = "ACTA TEST, Vol. 1\nfore treatment, pre- and before the two groups\n\n13"
    three = "ACTA TEST, Vol. 1\nthe two groups were repeated by technicians\n14"
    pages = spark.createDataFrame([(1, "P", 0, one), (2, "P", 1, two), (3, "P", 2, three), (4, "Q", 0, None), (5, "Q", 1, ""), (1, "P", 0, one)], "page_id bigint, paper_id string, page_index int, text string")
    repair = scan_repair.examine(pages, clean)
    got = {tuple(r) for r in scan_repair.found(repair).collect()}
    assert got == {
        (1, 1, "furniture", ""), (1, 5, "furniture", ""), (2, 1, "furniture", ""), (2, 4, "furniture", ""), (3, 1, "furniture", ""), (3, 3, "furniture", ""),
        (1, 2, "misread", "measurements"), (1, 2, "break", "technicians"), (1, 3, "misread", "between"), (1, 3, "break", "long-term"), (1, 4, "break", "before"),
    }
    flow = {r.page_id: r.text for r in scan_repair.reflowed(repair).collect()}
    assert flow[1] == "measurements were repeated by technicians between the two groups before long-term measurements were repeated before"
    assert flow[2] == "treatment, pre- and before the two groups" and flow[5] == ""
    assert scan_repair.found(scan_repair.examine(pages.limit(0), clean)).count() == 0


def test_scanned_reports_and_sentences(spark):
    clean = spark.createDataFrame([("measurements were repeated by long-term technicians between the two groups before treatment",)] * 30, "text string")
    one = "ACTA TEST, Vol. 1\nmeasurernents were repeated by tech-\nnicians betwcen the two groups before be-\n12"
    two = "ACTA TEST, Vol. 1\nfore treatment, pre- and before the two groups\n\n13"
    three = "ACTA TEST, Vol. 1\n   The two groups were repeated by technicians\n14"
    pages = spark.createDataFrame([(1, "P", 0, one), (2, "P", 1, two), (3, "P", 2, three)], "page_id bigint, paper_id string, page_index int, text string")
    whole = "\n\n".join((one, two, three))
    loose = "the gr0ups were measurernents by tech-\nnicians"
    reports = [(7, "P", whole, None), (8, "Q", loose, None), (9, "Q", None, None), (10, "Q", "", None), (7, "P", whole, None), (11, "R", three, [(0, three)])]
    reports = spark.createDataFrame(reports, "report_id bigint, paper_id string, text string, own array<struct<page int, page_text string>>")
    notes = [(7, "P", 0, "ACTA TEST, Vol. 1\nmeasurernents were repeated by tech‐"), (8, "P", 0, "nicians betwcen the two groups"), (9, "P", 0, "before be-\n12"), (10, None, None, "betwcen the two"), (11, "P", 0, None)]
    notes = spark.createDataFrame(notes, "ann_id bigint, paper_id string, page_index int, text string")
    got = {(r.kind, r.ref_id): r.text for r in scan_repair.repaired_texts(reports, notes, pages, clean).collect()}
    third = "The two groups were repeated by technicians"
    assert got == {
        ("report", 7): f"measurements were repeated by technicians between the two groups before before treatment, pre- and before the two groups\n\n{third}",
        ("report", 8): "the groups were measurements by technicians", ("report", 10): "", ("report", 11): third,
        ("annotation", 7): "measurements were repeated by technicians", ("annotation", 8): "technicians between the two groups",
        ("annotation", 9): "before before", ("annotation", 10): "between the two",
    }


def test_interrupted_within_a_piece(spark):
    rng = random.Random(8)
    item = [f"w{i}x" for i in range(60)]
    part = list(item[:24])
    for k in (1, 5, 21):
        part[k] = f"z{k}"
    filler = lambda n: [f"f{rng.randrange(9999)}" for _ in range(n)]
    far = item[:18] + filler(300) + [*item[18:21], "z", *item[22:24]]  # no whole piece behind the interruption
    short = item[:10] + filler(4) + item[10:16] + ["z"] + item[17:24]
    docs = {1: filler(5) + part[:14] + filler(40) + part[14:] + filler(9), 2: far, 3: short, 4: filler(5) + part[14:] + filler(40) + part[:14]}
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id bigint, text string")
    ev = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, passage string")
    assert {r.doc_id: r.distance for r in leakage.find_leaks(df, ev).collect()} == {1: 4, 2: 2, 3: 2}


def test_best_split_equals_brute_force():
    rng = random.Random(9)
    for _ in range(60):
        p, t = ([rng.randrange(4) for _ in range(rng.randrange(1, n))] for n in (9, 14))
        best = min(min(brute(p[:s], t[:c])) + min(brute(p[s:], t[c:])) for s in range(len(p) + 1) for c in range(len(t) + 1))
        assert leakage.split_distance(p, np.array(t)) == best + 1


def test_join_path_counts_each_item_once(spark, monkeypatch):
    rng = random.Random(6)
    rows = []
    for i in range(60):
        for j in rng.sample(range(7), 7 if i % 4 == 0 else 1 + i % 3):
            rows.append((i, f"s{j}", L[i % 4] if rng.random() < 0.6 else rng.choice(L)))
    df = spark.createDataFrame(rows, "item bigint, source string, label string")
    one = {r.item: (r.label, r.confidence) for r in consensus.fit_consensus(df, ["item"], rounds=2)[0].collect()}
    monkeypatch.setattr(consensus, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(consensus, "BLOCK", 7)
    two = {r.item: (r.label, r.confidence) for r in consensus.fit_consensus(df, ["item"], rounds=2)[0].collect()}
    assert one.keys() == two.keys()
    assert all(one[i][0] == two[i][0] and abs(one[i][1] - two[i][1]) < 1e-9 for i in one)
