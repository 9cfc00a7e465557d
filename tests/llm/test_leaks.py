import random
import unicodedata

import numpy as np
import pytest

from noticeloom.llm import leaks

P = {"ja": 6, "en": 9}


def brute(docs, items, share=0.4):
    out = set()
    for d, text in docs:
        t = leaks.reduced(text).tobytes()
        for i, item, lang in items:
            x, n = leaks.reduced(item), P[lang]
            inside = set()
            for p in range(len(x) - n + 1):
                k = t.find(x[p : p + n].tobytes())
                while k % 4 and k >= 0:
                    k = t.find(x[p : p + n].tobytes(), k + 1)
                if k >= 0:
                    inside |= set(range(p, p + n))
            if len(inside) and len(inside) >= share * len(x):
                out.add((d, i))
    return out


def made(seed):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("abcdefgh漢字仮名交文") for _ in range(n))
    items = [(i, word(r.randrange(1, 40)) + ("共通の結びの文です。" if i % 4 == 0 else ""), r.choice(["ja", "en"])) for i in range(25)]
    docs = []
    for d in range(60):
        parts = [word(r.randrange(0, 30))]
        for _ in range(r.randrange(3)):
            x = r.choice(items)[1]
            a = r.randrange(len(x))
            piece = x[a : a + r.randrange(4, 40)]
            parts += [r.choice([piece, piece.upper(), " ".join(piece), unicodedata.normalize("NFKC", piece), piece.replace("a", "ａ")]), word(r.randrange(9))]
        docs.append((d, "-".join(parts)))
    return docs, items


@pytest.mark.parametrize("seed, block", [(1, 2_000_000), (2, 150)])
def test_against_brute_force(spark, seed, block):
    docs, items = made(seed)
    hit = docs[min(brute(docs, items))[0]][1]
    docs += [(900, None), (901, ""), (902, hit * 300), (903, hit), (904, hit)]
    d = spark.createDataFrame(docs + docs[:4] + [(None, "x" * 50)], "doc_id long, text string")
    i = spark.createDataFrame(items + items[:3] + [(None, "abc" * 9, "en"), (77, None, "ja"), (78, "", None)], "item_id long, text string, lang string")
    got = [(r.doc_id, r.item_id) for r in leaks.leaked(d, i, passage=P, block_chars=block).collect()]
    assert len(got) == len(set(got)) and set(got) == brute([x for x in docs if x[1]], items)
    assert any(x[0] == 902 for x in got) and {b for a, b in got if a == 903} == {b for a, b in got if a == 904}


def test_empty(spark):
    d, i = spark.createDataFrame([(1, "abc")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string, lang string")
    assert leaks.leaked(d, i).count() == 0
    assert leaks.leaked(d.limit(0), spark.createDataFrame([(1, "abc" * 99, "en")], i.schema)).count() == 0


def test_equal_windows_always_collide_and_near_ones_mostly():
    r = np.random.default_rng(1)
    windows = r.integers(97, 120, (400, 23)).astype(np.uint32)
    again = leaks.walk_keys(windows.copy(), 3)
    assert (leaks.walk_keys(windows, 3) == again).all()
    tables = leaks.tables_for(23, 0.9, 1)
    changed = windows.copy()
    changed[np.arange(400), r.integers(0, 23, 400)] = 121
    a, b = leaks.walk_keys(windows, tables), leaks.walk_keys(changed, tables)
    assert tables > 1 and ((a == b).any(axis=0)).mean() >= 0.9
    assert ((a[:, :-1] == a[:, 1:]).any(axis=0)).mean() < 0.02


def altered(r, text, every):
    out = []
    for i, c in enumerate(text):
        kind = r.randrange(3) if i % every == every - 1 else 3
        out += {0: ["ゑ"], 1: [], 2: [c, "ゐ"], 3: [c]}[kind]
    return "".join(out)


def test_items_with_an_edit_every_twenty_signs_are_found_as_often_as_aimed_at(spark):
    r = random.Random(5)
    word = lambda signs, n: "".join(r.choice(signs) for _ in range(n))
    items = [(i, word("abcdefghijklmnop" if i % 2 else "漢字仮名交文春夏秋冬山川", 200), "en" if i % 2 else "ja") for i in range(120)]
    docs = [(i, word("qrstuvwxyz", 150) + altered(r, text, 20) + word("qrstuvwxyz", 90)) for i, text, _ in items] + [(1000 + i, altered(r, text, 4)) for i, text, _ in items]
    found = leaks.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string, lang string")).collect()
    assert {(x.doc_id, x.item_id) for x in found if x.doc_id >= 1000 or x.doc_id != x.item_id} == set()
    assert len(found) >= leaks.RECALL * len(items) and all(0.9 <= x.edit_share < 1 for x in found)
    assert sum(x.share >= leaks.SHARE for x in found) < 5


def distance(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_edit_distances_are_exact():
    r = random.Random(9)
    for _ in range(200):
        a, b = [r.choice([2, 3, 4]) for _ in range(r.randrange(1, 90))], [r.choice([2, 3, 4]) for _ in range(r.randrange(0, 90))]
        bits = {c: sum(1 << i for i, x in enumerate(a) if x == c) for c in set(a)}
        assert leaks.infix_distance(bits, len(a), b) == distance(a, b)
    item, doc = np.array([r.choice([2, 3, 4]) for _ in range(300)], np.uint32), np.array([r.choice([2, 3, 4]) for _ in range(300)] + [0] * 12, np.uint32)
    at, there = np.arange(250), np.array([r.randrange(250) for _ in range(250)])
    for edits in (0, 1, 3):
        got = leaks._within(doc, at, item, there, 8, edits)

        def brute(x, y):
            row = list(range(13))
            for i, p in enumerate(item[y : y + 8], 1):
                new = [i]
                for j, q in enumerate(doc[x : x + 12], 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != q)))
                row = new
            return min(min(row), edits + 1)

        assert got.tolist() == [brute(x, y) for x, y in zip(at, there)]


def test_a_closing_sentence_of_all_items_hides_nothing(spark):
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcdefghijklmnop漢字仮名交文") for _ in range(n))
    close = word(30)
    items = [(i, word(r.choice([0, 20, 60])) + close, "ja") for i in range(60)]
    docs = [(i, word(40) + close + word(9)) for i in range(20)] + [(100 + i, items[i][1] + word(5)) for i in range(20)] + [(200 + i, items[i][1][:30] + word(50) + close) for i in range(20)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string, lang string")
    want = set()
    for x, text in docs:
        for y, item, _ in items:
            inside = {q for p in range(len(item) - 24) if item[p : p + 25] in text for q in range(p, p + 25)}
            if inside and len(inside) >= 0.4 * len(item):
                want.add((x, y))
    assert leaks.HOT < 60 and {(x.doc_id, x.item_id) for x in leaks.leaked(d, i).collect()} == want
