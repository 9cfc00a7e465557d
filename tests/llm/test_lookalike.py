import pytest

from noticeloom.llm import lookalike

SCHEMA = "id long, text string, canonical string"


def run(spark, texts):
    rows = [(i, t, "own") for i, t in enumerate(texts)]
    out = lookalike.unified(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["id", "text", "canonical_in", "canonical", "stand_in"]
    return {r.id: (r.canonical, r.stand_in) for r in out.collect()}


CASES = [
    ("一等監", "一等監", False), ("ー等監", "一等監", True), ("Anаlyst I", "Analyst I", True), ("Вестник 位 α", "Вестник 位 α", False),
    ("ﾊﾝｶﾞｰ", "ハンガー", True), ("ハンガ一整備", "ハンガー整備", True), ("ハンガー整備", "ハンガー整備", False), ("八ンガー", "ハンガー", True), ("ハ区", "八区", True), ("データ", "データ", False),
    ("Ａ１", "A1", True), ("a\u00a0b", "a b", True), ("a\u3000b", "a b", True), ("Min\u200byu", "Minyu", True), ("\u304b\u309b", "\u304c", True), ("\u304b\u3099", "\u304c", True), ("e\u0304", "\u0113", True), ("\u0113", "\u0113", False),
    ("\u2f00等", "一等", True), ("\ufa19", "\u795e", True), ("\ufa11", "\ufa11", False), ("廣澤", "廣澤", False), ("等\U000e0100監", "等監", True), (None, None, False), ("", "", False), ("ニュース係", "ニュース係", False),
]


def test_texts_come_to_one_form(spark):
    got = run(spark, [c[0] for c in CASES])
    assert got == {i: c[1:] for i, c in enumerate(CASES)}


def test_the_vocabulary_decides_what_signs_alone_cannot(spark):
    got = run(spark, ["工口本部"] * 5 + ["エロ本部", "\u0406"] + ["I"] * 30)
    assert got[5] == ("工口本部", True) and got[6] == ("I", True)


def test_empty_and_long(spark):
    assert run(spark, []) == {}
    long = "ニ等監" * 50_000 + " ニ等監"
    assert run(spark, [long, "二等監", "二等監"])[0] == ("二等監" * 50_000 + " 二等監", True)


@pytest.mark.parametrize("word, budget, hit", [("ニ等監", 0, "二等監"), ("ニ等官", 0, None), ("ニ等官", 1, "二等監"), ("ニ監", 1, "二等監"), ("ニx等監", 1, "二等監"), ("x", 1, None), ("二‍等監", 0, "二等監")])
def test_automaton(word, budget, hit):
    trie = lookalike.Trie()
    trie.add("二等監", 3)
    trie.add("一等監督", 1)
    found = trie.search(word, budget)
    assert (found and found[2]) == hit


def test_the_cheapest_then_most_frequent_spelling_wins():
    trie = lookalike.Trie()
    for w, n in (("абв", 1), ("abc", 5), ("abd", 9)):
        trie.add(w, n)
    assert trie.search("abx", 1)[1:] == (-9, "abd") and trie.search("abc", 1)[:2] == (0.0, -5)


def test_cases_that_only_the_automaton_solves(spark):
    texts = ["Section"] * 50 + ["Sect1on", "Ｓect1​on", "C0l0nel", "A1b"] + ["Colonel"] * 60 + ["ハンガー"] * 3 + ["ﾊﾝｶ​ﾞ一"]
    got = run(spark, texts)
    at = {t: got[i] for i, t in enumerate(texts)}
    assert [at[t] for t in ("Sect1on", "Ｓect1​on", "C0l0nel", "A1b")] == [("Section", True), ("Section", True), ("Colonel", True), ("A1b", False)]
    assert at["ﾊﾝｶ​ﾞ一"] == ("ハンガー", True)
    assert all(lookalike.by_table(lookalike.fold(t)) != "Section" for t in ("Sect1on", "Ｓect1​on"))


def test_look_alikes_of_many_scripts(spark):
    signs = lookalike.public_signs(spark)
    assert (signs.latin["օ"], signs.latin["Օ"] if "Օ" in signs.latin else "O", signs.latin["ո"]) == ("o", "O", "n") and len(signs.latin) > 100
    assert run(spark, ["Cօlօnel", "Ստեփան"]) == {0: ("Colonel", True), 1: ("Ստեփան", False)}


def test_words_and_units_keep_what_is_written():
    assert lookalike.words_of("Ｍin​yu か゛x, 3rd Sect1on 12ab ēa") == ["Ｍin​yu", "か゛x", "rd", "Sect1on", "ab", "ēa"]
    trie = lookalike.Trie()
    trie.add("ハンガー", 3)
    assert trie.search("​ﾊﾝｶ​ﾞ一​") == (0.0, -3, "ハンガー")
    assert trie.search("ﾊﾝｶﾞ", 1, 1.0)[0] == 1.0 and trie.search("ﾊﾝｶﾞ", 1, 2.0) is None


def test_many_replacements_meet_their_texts_by_digest(spark, monkeypatch):
    small = run(spark, [c[0] for c in CASES] * 2)
    monkeypatch.setattr(lookalike, "BROADCAST_BYTES", -1)
    assert run(spark, [c[0] for c in CASES] * 2) == small
