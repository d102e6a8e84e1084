import random
import unicodedata

import pytest

from inkfall.llm import encoding, language, lookalikes, sentences


def look(text):
    parts = lookalikes.decompositions()
    return unicodedata.normalize("NFC", "".join(s for c in text for s, _ in parts.get(c, [(c, 0)])))


TEXTS = ["Ｆｕｌｌ ｗｉｄｔｈ", "é​ x", "é x", "cаfe ﬁne", "a b c‑d", "x² ≠ x2", "Ạ̇ Ḍ̇", "Ο Δρ. ναός", "บุคคล ำ", "नमस्ते", "漢字。（Ａ）", "ё й ї", "", "plain ascii", "́lone mark", "á̧", "long " * 5000]


def test_by_look_equals_plain_python(spark):
    rows = spark.createDataFrame([(i, t, "z") for i, t in enumerate(TEXTS)] + [(99, None, "z")], "id int, t string, look string")
    got = {r.id: r.look for r in lookalikes.by_look(rows, ["id"], "t").collect()}
    assert got.pop(99) is None
    assert got == {i: look(t) for i, t in enumerate(TEXTS)}
    assert lookalikes.by_look(rows.limit(0), ["id"], "t").collect() == []


def test_visible_differences_stay(spark):
    pairs = [("abc", "Abc"), ("é", "e"), ("10²", "102"), ("a b", "a  b"), ("a\nb", "a b")]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)] + [(9, "рaper", "paper"), (10, None, "x")], "id int, a string, b string")
    assert [r.id for r in lookalikes.same_look(rows, "id", rows.a, rows.b).collect()] == [9]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Dr. J. K. Lee saw it, e.g. at 8 a.m. on Monday. It was fine.", ["Dr. J. K. Lee saw it, e.g. at 8 a.m. on Monday.", "It was fine."]),
        ("“We felt safe. Nobody rushed us,” one said. The end.", ["“We felt safe. Nobody rushed us,” one said.", "The end."]),
        ("4. Study population\n\nText one\ngoes on. Two.", ["4. Study population", "Text one\ngoes on.", "Two."]),
        ("一位参与者说：“没有人催促。很安心。”样本在分析之前！", ["一位参与者说：“没有人催促。很安心。”", "样本在分析之前！"]),
        ("「急かされなかった。安心した。」と語った。次。", ["「急かされなかった。安心した。」と語った。", "次。"]),
        ("ผลลัพธ์หลัก 21 เดือน ตัวอย่างเลือด", ["ผลลัพธ์หลัก 21 เดือน", "ตัวอย่างเลือด"]),
        ("Am 3. Mai und am 14. Juni, vgl. Abb. 9 und Tab. 7. Die Probe.", ["Am 3. Mai und am 14. Juni, vgl. Abb. 9 und Tab. 7.", "Die Probe."]),
        ("(The remaining 4 were duplicates.) Mean was 4.5 (p = 0.1).", ["(The remaining 4 were duplicates.)", "Mean was 4.5 (p = 0.1)."]),
        ("", []),
        (" \n ", []),
    ],
)
def test_sentences(text, want):
    assert [text[a:b] for a, b in sentences.spans(text)] == want


def all_chains(text):
    """The best chain over all begins, none left out."""

    class Every(sentences._Begins):
        def add(self, place, at, score, depth):
            self.kept.append((place, at, score, depth))

    own, sentences._Begins = sentences._Begins, Every
    try:
        return sentences.spans(text)
    finally:
        sentences._Begins = own


def test_long_quotations_and_random_chains():
    for n in (58, 59, 60, 61, 62, 200):
        text = "She said: “" + "This is an inner sentence. " * n + "That was all.” Then she left."
        assert [text[a:b] for a, b in sentences.spans(text)] == [text[:-15], "Then she left."]
    rng = random.Random(3)
    parts = ["et al. ", "Fig. 3. ", "12. ", "A. ", "“", "”", "(", ")", "The dog ran. ", "x ", "e.g. ", "No. ", "She said so! ", "... ", "and more words to fill a line, " * 6, "。", "日本語です。", "「", "」"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(2, 60)))
        assert sentences.spans(text) == all_chains(text)


def test_sentences_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (3, "A bed was here. " * 3000, "z"), (4, "((( “ ", "z")], "id bigint, t string, sentence_index string")
    got = sentences.split_sentences(df, "id", "t").groupBy("id").count().collect()
    assert {r.id: r["count"] for r in got} == {3: 3000, 4: 1}


def test_encoding_is_the_library_s(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{encoding.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = ["Hello  world, it's 2024!", "<|endoftext|> 🧪📊\t\n\n x", "漢字 नमस्ते", "", None, "  ", "tail   ", "a" * 5000, "word " * 4000]
    df = spark.createDataFrame([(i, x, "z") for i, x in enumerate(texts)], "doc_id bigint, text string, ids string")
    want = {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    for hot in (0, 1, 3, 100_000):  # some, none or all of the words by the join
        rows = encoding.encode(df.unionByName(df), hot=hot).collect()
        assert len(rows) == len(texts) and {r.doc_id: list(r.ids) for r in rows} == want
    odd = spark.createDataFrame([(None, "a", 1), (None, "b", 1), ("x", "a", 2)], "doc_id string, text string, r int")
    assert sorted((r.doc_id or "", list(r.ids)) for r in encoding.encode(odd).collect()) == [("", [64]), ("", [65]), ("x", [64])]
    assert encoding.encode(odd.limit(0)).count() == 0
    back = {r.doc_id: r.text for r in encoding.decode(encoding.encode(df)).collect()}
    assert back == {i: x or "" for i, x in enumerate(texts)}
    assert encoding.encode(df.limit(0)).collect() == []


EN = "The patients were followed for twelve weeks. No difference was found between the groups. We conclude that the treatment is safe. "
DE = "Die Patienten wurden zwölf Wochen lang beobachtet. Zwischen den Gruppen gab es keinen Unterschied. Die Behandlung ist sicher. "
RU = "Пациенты наблюдались двенадцать недель. Разницы между группами не было. Лечение безопасно для всех. "


def test_languages(spark):
    rows = [(i, EN * 2, "English") for i in range(6)] + [(10 + i, DE * 2, "de-AT") for i in range(6)] + [(20 + i, RU * 2, "ru") for i in range(6)]
    rows += [(30, EN, None), (31, DE, "en"), (32, EN + "\n\n" + RU, "en"), (33, "12.5 77", "xx"), (34, None, None), (35, "", ""), (36, EN + "Cited title: “Die Patienten wurden”.", "eng"), (30, EN, None)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id bigint, text string, lang string, confidence string")
    found = language.languages(language.segments(docs, language.fit_profiles(docs)))
    got = sorted((r.doc_id, r.lang) for r in language.wrong_labels(docs, found).collect())
    assert got == [(30, "en"), (31, "de"), (32, "en"), (32, "ru")]
    assert all(0 <= r.confidence <= 1 for r in found.collect())
    empty = docs.limit(0)
    assert language.segments(empty, language.fit_profiles(empty)).count() == 0


def test_sentences_of_every_source(spark):
    from inkfall.llm.queries import QUERIES
    from inkfall.sources.tables import table

    folder = "/root/testdata/sf0.001"
    every, grobid = ({tuple(r) for r in QUERIES[q](spark, folder).collect()} for q in ("p4_sentences", "p4_found"))
    reports = {r.report_id: r for r in table(spark, folder, "coverage_reports").filter("trim(full_pdf_text) <> ''").collect()}
    assert {r[0] for r in every} == set(reports)
    assert {r for r in every if reports[r[0]].source == "grobid"} == grobid
    for rid, r in reports.items():
        left = list(r.full_pdf_text)
        for _, a, b in (x for x in every if x[0] == rid):
            left[a:b] = " " * (b - a)
        assert not "".join(left).strip()


def test_whole_results_are_queries(spark):
    from inkfall.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    got = {q: QUERIES[q](spark, folder).collect() for q in ("p2_texts", "p3_consensus", "p3_found")}
    assert {r.kind for r in got["p2_texts"]} >= {"needle", "report", "quote"}
    assert len({(r.kind, r.ref_id) for r in got["p2_texts"]}) == len(got["p2_texts"])
    whole = {(r.paper_id, r.field_index): r.label for r in got["p3_consensus"]}
    assert len(whole) > len(got["p3_found"]) and all(whole[r.paper_id, r.field_index] == r.label for r in got["p3_found"])
    assert {"p6_survivors", "p8_leaks"} <= set(QUERIES)


def test_quotations_count_by_their_sentences_not_their_length(spark):
    de, en = "Der Hund lief durch den Garten und bellte laut", "The dog ran through the garden and barked very loud today"
    docs = [(f"d{i}", x * 20, "de") for i, x in enumerate([de + ". "] * 5)] + [(f"e{i}", x * 20, "en") for i, x in enumerate([en + ". "] * 5)]
    spark_docs = spark.createDataFrame(docs, "doc_id string, text string, lang string")
    profiles = language.fit_profiles(spark_docs)
    rows = []
    for n in (2, 5, 6, 7, 30):  # below and above 300 characters
        rows.append((f"title {n}", f"{(en + '. ') * n}He calls it “{(de + ', ') * n}und mehr” and went on. {en}.", None))  # most of the text is not quoted
        rows.append((f"text {n}", f"{en}. {en}. “{(de + '. ') * n}{de}.” {en}. {en}.", None))
    got = {}
    for r in language.segments(spark.createDataFrame(rows, spark_docs.schema), profiles).collect():
        got.setdefault(r.doc_id, set()).add(r.lang)
    assert got == {k: {"en"} if k.startswith("title") else {"de", "en"} for k, _, _ in rows}


def test_ngrams_of_many_different_letters():
    texts = ["ab ab", "", "字母 " + "".join(map(chr, range(0x4E00, 0x4F00)))]
    assert all((a == b).all() for a, b in zip(language.ngrams(texts), language._halves(texts), strict=True))


def test_costs_in_parts():
    units = [EN, DE, "", RU, "12"] * 3
    table = language.Table({"en": language.ngrams([EN])[1][:50].tolist(), "de": language.ngrams([DE])[1][:50].tolist()})
    one, many = language.costs(table, units, 10**6), language.costs(table, units, 30)
    assert all((a == b).all() for a, b in zip(one, many, strict=True)) and language.costs(table, [])[0].shape == (0, 2)
