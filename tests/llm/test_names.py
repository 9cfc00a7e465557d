import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeloom.llm import metric, names


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_distances_are_edit_distances():
    r = random.Random(1)
    words = ["".join(r.choice("abcあ") for _ in range(r.randrange(0, 30))) for _ in range(80)] + ["x" * 500]
    pivots = [w for w in words if 0 < len(w) <= metric.LONGEST_PIVOT][:15]
    d = metric.distances(pivots, words)
    assert all(d[i, j] == distance(w, p) for i, w in enumerate(words) for j, p in enumerate(pivots))


@pytest.mark.parametrize("radius", [1, 2])
def test_radius_join_is_exact(spark, monkeypatch, radius):
    monkeypatch.setattr(metric, "LONG", 9)
    r = random.Random(radius)
    words = {"".join(r.choice("ab漢") for _ in range(r.choice([2, 3, 5, 8, 9, 10, 11, 12, 20]))) for _ in range(150)}
    for w in list(words):
        i = r.randrange(len(w))
        words |= {w[:i] + r.choice("abz") + w[i + r.randrange(2) :], w[:i] + w[i + 1 :]}
    words.discard("")
    df = spark.createDataFrame([(w,) for w in words] + [(w,) for w in list(words)[:5]] + [(None,), ("",)], "s string")
    got = {(x.a, x.b) for x in metric.radius_join(df, radius, sample=40, pivots=8).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and distance(a, b) <= radius}
    assert metric.radius_join(df.limit(0), radius).count() == 0
    some = df.withColumn("visits", F.length("s") % 2 == 0)
    seen = {(x.a, x.b) for x in metric.radius_join(some, radius, sample=40, pivots=8).collect()}
    assert seen == {(a, b) for a, b in got if len(a) % 2 == 0 or len(b) % 2 == 0}


def plain_tree(strings, native, scale, rows, seed=1):
    n = len(strings)
    here = n * (1 + min(n * scale / metric.PAIRS_A_ROW, sum(map(len, strings)) / n if n else 0))
    if n * scale <= rows or n <= 8 or not (cutting := metric._divide(strings, native, 1, 6, seed)):
        return here, None
    d, parts = metric.distances([cutting[0]], strings)[:, 0], []
    for side, (there, own) in enumerate(zip(metric._sides(d, native, cutting[1], cutting[2], 1), (d <= cutting[1], d > cutting[1]))):
        at = np.flatnonzero(there)
        if len(at) == n:
            return here, None
        parts.append(plain_tree([strings[i] for i in at], (native & own)[at], scale, rows, seed * 2 + side))
    cost = sum(c for c, _ in parts)
    return (cost, (*cutting, *(t for _, t in parts))) if cost < here else (here, None)


@pytest.mark.parametrize("alphabet, lengths, n, scale, rows, most", [("abcdefgh漢字仮名", (2, 4, 5, 5, 7), 600, 2.0, 40, 40), ("abcdefghijklmnopqrst", (4, 8, 16, 32), 700, 3.0, 30, 150)])
def test_the_best_tree_without_trying_parts_that_cannot_pay(monkeypatch, alphabet, lengths, n, scale, rows, most):
    r = random.Random(n)
    words = sorted({"".join(r.choice(alphabet) for _ in range(r.choice(lengths))) for _ in range(n)})
    native = np.array([r.random() < 0.9 for _ in words])
    tried, divide = [], metric._divide
    monkeypatch.setattr(metric, "_divide", lambda *a: tried.append(a) or divide(*a))
    cost, tree = metric._tree(words, native, 1, 6, scale, rows)
    assert len(tried) <= most  # plainly, all parts of parts: some 100 and 2,000
    if n == 600:
        want, same = plain_tree(words, native, scale, rows)
        assert tree == same and tree is not None and abs(cost - want) < 1e-6


def test_components(spark):
    from noticeloom.runtime import Scratch

    links = [(f"c{i:03}", f"c{i + 1:03}") for i in range(70)] + [("x", "y"), ("z", "y"), ("y", "x"), ("q", "q")]
    got = {r.node: r.label for r in names.components(spark.createDataFrame(links, "a string, b string"), Scratch(spark)).collect()}
    assert got == {f"c{i:03}": "c000" for i in range(71)} | {"x": "x", "y": "x", "z": "x", "q": "q"}


PEOPLE = [
    ["山川一二三", "山 川 一二三", "一二三 山川", "山川一二三殿", "山川(一)", "山川 一坊", "山川一二三 (兼)", "山川一三", "上級官 山川一二三"],
    ["沢田学美子", "澤田學美子"],
    ["山川四五六"],
    ["Kelda Morivan", "KELDA, Morivan", "Morivan Kelda", "Mr Kelda Morivan", "Kelda Moirvan", "Kelda M.", "Mori. Kelda", "Kelda Mokko"],
    ["Kelda Tesserin", "kelda tesserin", "Kelda Teserin"],
]
UNITS = [
    ["花鳥風第3整備大隊", "花鳥風第三整備大隊", "花鳥風3整備大隊", "第3整備大隊 花鳥風", "第3整備大隊(花鳥風)", "花鳥3整大隊", "花鳥月第3整備大隊"],
    ["花鳥風第4整備大隊"],
    ["花鳥風第3管理本部"],
    ["花鳥風整備大隊", "整備大隊(花鳥風)"],
    ["Norvale 3rd Supply Depot", "NORVALE 3RD SUPPLY DEPOT", "3rd Supply Depot, Norvale", "Norvale Third Supply Depot", "Norva SD-3", "Norvale 3rd Sup. Dep.", "Norvael 3rd Supply Depot", "Norvale 3rd Supply"],
    ["Norvale 3rd Audit Section"],
    ["Norvale 13th Supply Depot"],
]
FILLER = [f"{p}第{n}{k}" for p in ("青空海", "赤土原", "白雪岳") for n in range(1, 6) for k in ("整備大隊", "管理本部")] + [f"{p} {n}th {k}" for p in ("Quibbek", "Zostrum") for n in range(4, 10) for k in ("Supply Depot", "Audit Section")]


def test_variants_are_linked_and_namesakes_apart(spark):
    rows = [("person", n) for g in PEOPLE for n in g] + [("organisation", n) for g in UNITS for n in g] + [("organisation", n) for n in FILLER] + [("person", None), ("person", " "), ("other", "x"), ("person", "沢田学美子")]
    df = spark.createDataFrame(rows, "kind string, name string").withColumn("entity", F.lit(1))
    grouped = names.variants(df, titles=["上級官"])
    got = {}
    for r in grouped.collect():
        got.setdefault((r.kind, r.entity), set()).add(r.name)
    want = {frozenset(g) for g in PEOPLE + UNITS if len(g) > 1}
    assert {frozenset(g) for g in got.values()} == want
    pairs = names.pairs(grouped).collect()
    assert len(pairs) == sum(len(g) * (len(g) - 1) // 2 for g in want) and all(p.name_a < p.name_b for p in pairs)


def test_an_abbreviation_of_two_people_joins_neither(spark):
    rows = ["田村春男子", "田村春女丙", "田村(春)", "Orin Vastel", "Orin Vokkam", "V. Orin"]
    assert names.variants(spark.createDataFrame([("person", n) for n in rows], "kind string, name string")).count() == 0


def test_odd_input(spark):
    long = "長" * 30_000
    df = spark.createDataFrame([("person", x) for x in (long, long + "い", "(", ".", "・", "　", "a", "Mr", "()", "‍")] + [("organisation", x) for x in (long, "第", "3", "-", "x 3")], "kind string, name string")
    got = names.variants(df).collect()
    assert {r.name for r in got} == {long, long + "い"}
    assert names.variants(df.limit(0)).count() == 0


@pytest.mark.parametrize("rows, radius", [(30, 1), (400, 1), (30, 2)])
def test_cells_lose_no_pair_and_replicate_little(spark, monkeypatch, rows, radius):
    monkeypatch.setattr(metric, "PAIR_ROWS", 12)
    r = random.Random(rows)
    words = {"".join(r.choice("abcdefgh漢字仮名") for _ in range(r.choice([2, 4, 5, 5, 7]))) for _ in range(500)}
    for w in list(words):
        i = r.randrange(len(w))
        words |= {w[:i] + r.choice("abz") + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + w[i : i + 2][::-1] + w[i + 2 :]}
    words = sorted(w for w in words if w)
    df = spark.createDataFrame([("x" if len(w) % 2 else "y", w) for w in words] + [("y", w) for w in words[:200]], "block string, s string")
    got = [(x.block, x.a, x.b) for x in metric.radius_join(df, radius, sample=300, rows=rows).collect()]
    blocks = {"x": [w for w in words if len(w) % 2], "y": sorted({w for w in words if not len(w) % 2} | set(words[:200]))}
    assert sorted(got) == sorted((k, a, b) for k, ws in blocks.items() for a in ws for b in ws if a < b and distance(a, b) <= radius)


def test_one_crowded_cell_without_a_division(spark):
    words = [a + b for a in "abcdefghijklmno" for b in "abcdefghijklmno"]
    got = metric.radius_join(spark.createDataFrame([(w,) for w in words], "s string"), 1, sample=50, rows=20).collect()
    assert len(got) == sum(distance(a, b) == 1 for a in words for b in words if a < b) == len({(x.a, x.b) for x in got})


def groups(spark, rows, **options):
    got = {}
    for r in names.variants(spark.createDataFrame(rows, "kind string, name string"), **options).collect():
        got.setdefault(r.entity, set()).add(r.name)
    return {frozenset(g) for g in got.values()}


def test_short_names_have_slips_too(spark):
    people = ["山田太郎", "山田大郎", "沢村一", "沢村二", "沢村一二三", "沢村二四五", "李四", "李五"]
    assert groups(spark, [("person", n) for n in people]) == {frozenset(x) for x in (("山田太郎", "山田大郎"), ("李四", "李五"))}


def test_rare_kinds_are_kinds(spark):
    units = [f"青空海第{n}整備大隊" for n in range(1, 120)] + ["赤土原第3監査班", "赤土原第3監理班", "赤土原第4監査班", "赤土原第4監理班"]
    assert groups(spark, [("organisation", n) for n in units]) == set()


def test_names_of_four_parts_and_names_that_end_like_nicknames(spark):
    people = ["Ana Maria Lopez Vidal", "Lopez Vidal Ana Maria", "Vidal, Ana Maria Lopes", "Tristan Lee", "Tristam Lee", "Trisha Lee", "甲 乙 丙 丁", "丁 甲 乙 丙"]
    want = {frozenset(x) for x in (people[:3], people[3:5], people[6:])}
    assert groups(spark, [("person", n) for n in people]) == want


def test_endings_of_nicknames_are_learned(spark):
    given = ["Morivan", "Tesserin", "Bakelot", "Dunfarl", "Hexamon", "Ogrindel"]
    people = [f"Kelda {g}" for g in given] + [f"Kelda {g[:4]}zun" for g in given[:5]] + ["Vastel Orin"]
    assert groups(spark, [("person", n) for n in people]) == {frozenset((f"Kelda {g}", f"Kelda {g[:4]}zun")) for g in given[:5]}
