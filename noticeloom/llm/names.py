"""Variant spellings of names typed by people.

Each spelling is read into forms: full forms, which are compared under the edit distance by the radius join of metric.py,
and short forms, which an abbreviation asks for and every longer spelling offers. Readings undo what is not a matter of
distance: order of parts, titles, old characters, numerals, abbreviated kinds of unit. Links between full forms make
components; an abbreviation joins one only if no other component offers the same short form. Kinds of unit and endings of
nicknames are learned from the names themselves.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Scratch, spread
from . import lookalike, metric

# Old forms of ideographs and their present forms.
OLD = dict(zip("廣澤關學實惠峯嶋嶌冨國﨑嵜黑靑瀨眞鹽鐵龜櫻凉遙舘薗邊邉齋齊濱濵髙德榮圓增晧曉靜藏圖萬與豐寶辯壽澁淺龍瀧莊條鷗祿神祥福靖", "広沢関学実恵峰島島富国崎崎黒青瀬真塩鉄亀桜涼遥館園辺辺斎斉浜浜高徳栄円増皓暁静蔵図万与豊宝弁寿渋浅竜滝荘条鴎禄神祥福靖"))
# What may follow or precede a person's name, and endings of nicknames.
TITLES_AFTER = ("先生", "氏", "殿", "様")
TITLES_LATIN = {"mr", "mrs", "ms", "miss", "dr", "prof", "sir"}
NICK_AFTER = ("ちゃん", "くん", "やん", "ちん", "っち", "坊")
NICK_LATIN = ("chin", "ppe", "kko")
# Numerals in words.
NUMBER_WORDS = {w: str(i) for i, w in enumerate("first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth".split(), 1)}
_KANJI = {c: i for i, c in enumerate("〇一二三四五六七八九")}

#: A kind of unit is a slip of another if that is so many times as frequent.
KIND_SLIP = 3
#: An ending of at most so many letters makes nicknames if, of the names that have it, this share and this number shorten
#: another name of the family.
NICK_LETTERS, NICK_SHARE, NICK_NAMES = 5, 0.5, 3
#: Letters of a place's name that an abbreviation of it may have.
PLACE_PREFIX = 64
_LATIN = re.compile("[A-Za-z]")


@dataclass
class Reading:
    """Forms of one spelling. A form is compared only with others of the same sort."""

    full: set[str] = field(default_factory=set)
    asks: set[str] = field(default_factory=set)
    offers: dict[str, str] = field(default_factory=dict)  # short form: what it shortens
    nicks: dict[str, str] = field(default_factory=dict)  # short forms that hold if the ending makes nicknames


def plain(text: str) -> str:
    """One form for every encoding, present forms for old ones."""
    return "".join(OLD.get(c, c) for c in " ".join(lookalike.by_table(w) for w in lookalike.fold(text).split()))


def _bare(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


def read_person(name: str, titles: tuple[str, ...] = ()) -> Reading:
    """Readings of a person's name. titles: words that may stand before a name, such as ranks, longest first."""
    text, out = plain(name), Reading()
    for title in titles:
        if text.lower().startswith(title.lower() + " ") and len(text) > len(title) + 1:
            text = text[len(title) + 1 :]
    if _LATIN.search(text):
        text = _bare(text)
        text = re.sub(r"\s*\([^)]{2,}\)$", "", text)
        tokens = [t for t in re.findall(r"[a-z'\-]+\.?|\([a-z]\)", text) if t.strip(".") not in TITLES_LATIN]
        tokens = [t.strip("()") + "." * t.startswith("(") for t in tokens]
        whole = [t for t in tokens if not (t.endswith(".") or len(t) == 1)]
        if len(tokens) == 2 and len(whole) == 1:
            short = next(t for t in tokens if t != whole[0])
            out.asks.add(f"{whole[0]}|{short.strip('.')}")
        elif len(tokens) > 3 or not tokens:
            out.full |= {" ".join(tokens), " ".join(sorted(tokens))} if tokens else {text}
        else:
            tokens = [t.strip(".") for t in tokens]
            out.full |= {" ".join(p) for p in permutations(tokens)}
            if len(tokens) == 2:
                for a, b in permutations(tokens):
                    out.offers |= {f"{a}|{b[:k]}": b for k in range(1, len(b))}
                    out.nicks |= {f"{a}|{b[:-k]}": b[-k:] for k in range(2, NICK_LETTERS + 1) if len(b) > k}
        return out
    initial = re.fullmatch(r"(\S{1,3})\s?(?:\((\S)\)|(\S)\.|\s(\S))", text) or re.fullmatch(r"(\S{1,3}) (\S)", text) or re.fullmatch(rf"(\S{{1,3}}) (\S)(?:{'|'.join(NICK_AFTER)})", text)
    if initial:
        out.asks.add(f"{initial[1]}|{next(g for g in initial.groups()[1:] if g)}")
        return out
    text = re.sub(r"\s*\([^)]*\)$", "", text) or text
    for after in TITLES_AFTER:
        if text.endswith(after) and len(re.sub(r"\W", "", text)) - len(after) >= 4:
            text = text[: -len(after)]
            break
    parts = re.split(r"[\s・,、,·]+", text.strip())
    if len(parts) == 2 and len(parts[1]) == 1 and len(parts[0]) >= 2:
        out.asks.add(f"{parts[0]}|{parts[1]}")
        return out
    orders = {"".join(parts)}
    if len(parts) == 2:
        orders.add(parts[1] + parts[0])
    elif len(parts) == 3:
        orders.add(parts[2] + parts[0] + parts[1])
    elif len(parts) > 3:
        orders.add("".join(sorted(parts)))
    out.full |= orders
    out.offers |= {f"{o[:k]}|{o[k]}": o for o in orders for k in (1, 2, 3) if len(o) > k + 1}
    return out


def _digits(text: str) -> str:
    """Numerals after 第 in figures."""

    def figure(m: re.Match) -> str:
        total = now = 0
        for c in m[1]:
            if c == "十":
                total, now = total + (now or 1) * 10, 0
            else:
                now = now * 10 + _KANJI[c]
        return f"第{total + now}"

    return re.sub("第([〇一二三四五六七八九十]+)", figure, text)


def numbered_kind(name: str) -> str | None:
    """What follows the number in a spelling of the plain shape place-number-kind; kinds are learned from these."""
    text = plain(name)
    if m := re.fullmatch(r"\w+?第\d+([^\W\d]{2,})", _digits(text)):
        return m[1]
    if (m := re.fullmatch(r"[A-Z][a-z]+ \d+(?:st|nd|rd|th)((?: [A-Z][a-z]+)+)", _bare_case(text))) and len(m[1].split()) > 1:
        return m[1].strip().lower()
    return None


def _bare_case(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c) or "゙" <= c <= "゚")


def proper_kinds(counts: dict[str, int]) -> frozenset[str]:
    """The kinds among `counts` that are not an abbreviation of a more frequent one or a slip of one three times as frequent."""

    def worse(k: str, other: str) -> bool:
        shorter = len(k) < len(other) and k[0] == other[0] and k[-1] == other[-1] and _within(k, other)
        return counts[other] >= KIND_SLIP * counts[k] and one_slip(k, other) or counts[other] > counts[k] and shorter

    return frozenset(k for k in counts if not any(worse(k, other) for other in counts if other != k))


def _within(short: str, long: str) -> bool:
    rest = iter(long)
    return all(c in rest for c in short)


def kind_of(text: str, kinds: frozenset[str]) -> str | None:
    """The kind that `text` names or abbreviates, if there is exactly one."""
    if text in kinds:
        return text
    if len(text) < 2:
        return None
    cut = [k for k in kinds if len(k) - len(text) == 1 and k.startswith(text)]
    if len(cut) == 1:
        return cut[0]
    inner = [k for k in kinds if text[0] == k[0] and text[-1] == k[-1] and len(text) < len(k) and _within(text, k)]
    return inner[0] if len(inner) == 1 else None


def kind_of_latin(tokens: list[str], kinds: frozenset[str]) -> str | None:
    text = " ".join(t.strip(".") for t in tokens)
    if text in kinds:
        return text
    if len(tokens) == 1:
        by = [k for k in kinds if "".join(w[0] for w in k.split()) == text and len(text) > 1] or [k for k in kinds if k.split()[0] == text]
        return by[0] if len(by) == 1 else None
    words = {w for k in kinds for w in k.split()}
    if any(t.strip(".") in words for t in tokens if len(t) > 4):
        return None
    same = [k for k in kinds if len(k.split()) == len(tokens) and all(t[0] == w[0] and len(t.strip(".")) < len(w) for t, w in zip(tokens, k.split()))]
    if len(same) > 1:
        same = [k for k in same if all(_within(t.strip("."), w) for t, w in zip(tokens, k.split()))]
    return same[0] if len(same) == 1 else None


def _unit(place: str, number: str, kind: str) -> Reading:
    key = f"#{number}#{kind}"
    return Reading({place + key}, {place + key}, {place[:k] + key: place for k in range(2, min(len(place), PLACE_PREFIX + 1))})


def read_organisation(name: str, kinds: frozenset[str]) -> Reading:
    """Readings of a unit's name as place, number and kind. What cannot be read that way is compared as it stands."""
    text = plain(name)
    if _LATIN.search(text):
        text = _bare(text)
        tokens = re.findall(r"[a-z']+-?\d+|\d+[a-z]*|[a-z']+\.?|,", text)
        place_last = "," in tokens
        tokens = [t for t in tokens if t != ","]
        number, words = "", []
        for t in tokens:
            if m := re.fullmatch(r"([a-z']*)-?(\d+)(?:st|nd|rd|th)?", t):
                number = m[2]
                words += [m[1]] if m[1] and m[1] not in ("st", "nd", "rd", "th") else []
            elif t in NUMBER_WORDS:
                number = NUMBER_WORDS[t]
            else:
                words.append(t)
        if len(words) < 2:
            return Reading({text})
        first_is_place = not place_last and not re.match(r"\d", tokens[0]) and tokens[0] not in NUMBER_WORDS
        choices = [(words[-1], words[:-1])] if place_last or not first_is_place else [(words[0], words[1:]), (words[-1], words[:-1])]
        for place, rest in choices:
            if kind := kind_of_latin(rest, kinds):
                return _unit(place.strip("."), number, kind)
        place, rest = choices[0]
        return Reading({f"{place}#{number}#{' '.join(rest)}"})
    text = _digits(re.sub(r"\s*内$", "", text) if kind_of(re.sub(r".*\d", "", text), kinds) is None else text)
    m = re.fullmatch(r"(.+?)\s*\((.+)\)", text)
    parts = [m[1], m[2]] if m else re.split(r"[\s・/、,]+", text)
    if len(parts) == 2 and (n := re.fullmatch(r"(?:第?(\d+))?(\D+)", parts[0])) and (kind := kind_of(n[2], kinds)):
        return _unit(parts[1], n[1] or "", kind)
    text = "".join(parts)
    if m := re.fullmatch(r"(\D+?)第?(\d+)(\D+)", text):
        kind = kind_of(m[3], kinds)
        return _unit(m[1], m[2], kind) if kind else Reading({f"{m[1]}#{m[2]}#{m[3]}"})
    for rule in (lambda x: x in kinds, lambda x: kind_of(x, kinds) is not None):
        for at in range(2, len(text) - 1):
            if rule(text[at:]):
                return _unit(text[:at], "", kind_of(text[at:], kinds))
    for at in range(2, len(text) - 1):
        if any(len(k) == len(text) - at and sum(a != b for a, b in zip(k, text[at:])) == 1 for k in kinds):
            return Reading({f"{text[:at]}##{text[at:]}"})
    return Reading({text})


def one_slip(a: str, b: str) -> bool:
    """Whether one substitution, insertion, deletion or swap of neighbours turns a into b."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or len(x) > 1 and len(y) > 1 and x[0] == y[1] and x[1] == y[0] and x[2:] == y[2:]


def same_unit(a: str, b: str, kinds: frozenset[str]) -> bool:
    """Full forms of units may differ in place or in an unknown kind, never in number, and never by one known kind for another."""
    x, y = a.split("#"), b.split("#")
    if len(x) != 3 or len(y) != 3:
        return len(x) == len(y)
    return x[1] == y[1] and (x[2] == y[2] or not (x[2] in kinds and y[2] in kinds))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label: the smallest node of its component, for the undirected links (a, b). Labels spread to neighbours and
    are then followed to their own label, so long chains take a number of rounds that grows with their logarithm."""
    both = scratch.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    now = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        near = both.join(now.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen"))
        spread = now.join(near, "node").select("node", F.least("label", "seen").alias("label2"), "label")
        jump = spread.join(now.select(F.col("node").alias("label2"), F.col("label").alias("further")), "label2", "left")
        after = scratch.keep(jump.select("node", F.least("label2", F.coalesce("further", "label2")).alias("label"), "label", "label2").toDF("node", "label", "old", "mid"))
        moved = after.where("label <> old").limit(1).count()
        scratch.drop(now)
        now = after.select("node", "label")
        if not moved:
            return now


def variants(names: DataFrame, titles: list[str] = (), scratch: Scratch | None = None) -> DataFrame:
    """kind, name, entity: the different spellings of the columns kind (`person` or `organisation`) and name, and the
    smallest spelling of the group each belongs to. Spellings without a variant are left out.

    Null names and names without a letter or digit belong to nobody; repeated rows count once. A full form is compared with all others of its
    kind; nothing is sampled but the choice of pivots.
    """
    spark = names.sparkSession
    scratch = scratch or Scratch(spark)
    rows = scratch.keep(names.select("kind", "name").where("kind in ('person', 'organisation')").where(F.col("name").rlike(r"[\p{L}\p{N}]")).distinct())

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"unit": [k for n in pdf.name if (k := numbered_kind(n))]}, dtype=object)

    units = rows.where("kind = 'organisation'").mapInPandas(learn, "unit string").groupBy("unit").count()
    known = proper_kinds({r.unit: r["count"] for r in _not_slips(scratch.keep(units), scratch).toLocalIterator()})  # a vocabulary
    before = tuple(sorted(titles, key=len, reverse=True))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for kind, name in zip(pdf.kind, pdf.name):
                r = read_person(name, before) if kind == "person" else read_organisation(name, known)
                lead = min(r.full, default=None)  # one order of the parts looks for others, which are there in all orders
                out += [(kind, name, sort, kind[0] + form, form == lead, lead) for sort, forms in (("full", r.full), ("ask", r.asks)) for form in sorted(forms)]
                out += [(kind, name, "offer", kind[0] + form, False, whole) for form, whole in r.offers.items() if form not in r.asks]
                out += [(kind, name, "nick", kind[0] + form, False, ending) for form, ending in r.nicks.items()]
            yield pd.DataFrame(out, columns=["kind", "name", "sort", "form", "lead", "ending"])

    forms = scratch.keep(spread(rows, "name").mapInPandas(read, "kind string, name string, sort string, form string, lead boolean, ending string"))
    full = scratch.keep(forms.where("sort = 'full'").select("form", "name", "kind", "lead", F.concat(F.substring("form", 1, 1), "ending").alias("first")).distinct())
    nicked = scratch.keep(_nicknames(forms.where("sort = 'nick'"), forms.where("sort = 'offer'")))
    different = full.groupBy("form").agg(F.max("lead").alias("visits"))
    nicknames = full.join(nicked.select("kind", "name").distinct(), ["kind", "name"], "left_semi").select("form").distinct()
    close = scratch.keep(_slips(different, nicknames, known, scratch))
    # a form stands for all spellings that have it: a spelling is where its leading form is, its other forms are linked to that
    links = close.select("a", "b").unionByName(full.where("not lead").select(F.col("first").alias("a"), F.col("form").alias("b")))
    whole = components(links, scratch)
    by_name = full.where("lead").select("kind", "name", "form").join(whole, F.col("form") == F.col("node"), "left")
    by_name = scratch.keep(by_name.select("kind", "name", F.coalesce("label", "form").alias("label")))
    asks = scratch.keep(forms.where("sort = 'ask'").select("kind", "name", "form").unionByName(nicked).distinct())
    # a nickname is no name to shorten, and short forms that nobody asks for need no owner
    offering = forms.where("sort = 'offer'").select("kind", "name", "form").join(asks.select("form").distinct(), "form", "left_semi").distinct().join(nicked.select("kind", "name").distinct(), ["kind", "name"], "left_anti").join(by_name, ["kind", "name"])
    offers = offering.groupBy("form").agg(F.min("label").alias("label"), F.max("label").alias("last")).where("label = last").select("form", "label")
    placed = asks.join(offers, "form").groupBy("kind", "name").agg(F.min("label").alias("label"), F.max("label").alias("last")).where("label = last").select("kind", "name", "label")
    placed = scratch.keep(placed)
    # a unit or a nickname may have a full form of its own and ask as well: then its whole component moves
    moved = placed.join(by_name.withColumnRenamed("label", "own"), ["kind", "name"], "left")
    alone = asks.join(by_name.select("kind", "name"), ["kind", "name"], "left_anti").join(placed.select("kind", "name"), ["kind", "name"], "left_anti").select("kind", "name", F.concat(F.lit("s"), "form").alias("label"))
    alike = nicked.join(placed.select("kind", "name"), ["kind", "name"], "left_anti").join(by_name, ["kind", "name"]).select(F.col("label").alias("a"), F.concat(F.lit("s"), "form").alias("b"))
    steps = scratch.keep(moved.where("own is not null and own <> label").select(F.col("own").alias("a"), F.col("label").alias("b")).unionByName(alike).distinct())
    merged = components(steps, scratch)
    entity = by_name.unionByName(moved.where("own is null").select("kind", "name", "label")).unionByName(alone)
    entity = entity.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select("kind", "name", F.coalesce("to", "label").alias("label"))
    entity = scratch.keep(entity.distinct())
    group = entity.groupBy("kind", "label").agg(F.min("name").alias("entity"), F.count("*").alias("n")).where("n > 1")
    return entity.join(group, ["kind", "label"]).select("kind", "name", "entity")


def _swapped(words: DataFrame) -> DataFrame:
    """a, b: different words of the column s with the same letters, one swap of neighbours or the like apart."""
    letters = words.select("s", F.array_join(F.array_sort(F.split("s", "")), "").alias("bag"))
    both = letters.alias("p").join(letters.alias("q"), F.col("p.bag") == F.col("q.bag")).where("p.s < q.s")
    return both.select(F.col("p.s").alias("a"), F.col("q.s").alias("b")).where(F.levenshtein("a", "b", 2) == 2)


def _not_slips(units: DataFrame, scratch: Scratch) -> DataFrame:
    """unit, count of the kinds that are not one slip away from one KIND_SLIP times as frequent."""
    words = units.select(F.col("unit").alias("s"))
    near = metric.radius_join(words, 1, scratch=scratch).select("a", "b").unionByName(_swapped(words))
    pairs = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = lambda c: units.select(F.col("unit").alias(c), F.col("count").alias(f"n_{c}"))
    slips = pairs.join(counted("a"), "a").join(counted("b"), "b").where(F.col("n_b") >= KIND_SLIP * F.col("n_a")).select(F.col("a").alias("unit")).distinct()
    return units.join(slips, "unit", "left_anti")


def _slips(different: DataFrame, nicknames: DataFrame, known: frozenset[str], scratch: Scratch) -> DataFrame:
    """a, b: full forms that are one slip apart and have a letter in common. Units are compared with units of the same number
    only.

    Two forms that are both shortened are no slips of each other, since what tells them apart may be what is missing: a form
    is shortened if it is a nickname, the beginning of one two letters longer, or one letter short of another.
    """
    parts = F.split(F.substring("form", 2, 1 << 30), "#")
    numbered = F.col("form").startswith("o") & (F.size(parts) == 3)
    block = F.when(numbered, F.concat(F.lit("o#"), parts[1])).otherwise(F.concat(F.substring("form", 1, 1), F.size(parts).cast("string")))
    placed = different.select(block.alias("block"), F.when(numbered, F.concat(parts[0], F.lit("#"), parts[2])).otherwise(F.array_join(parts, "#")).alias("s"), "visits")

    def form(c: str):
        x = F.split(c, "#")
        return F.when(F.col("block").startswith("o#"), F.concat(F.lit("o"), x[0], F.lit("#"), F.substring("block", 3, 1 << 30), F.lit("#"), x[1])).otherwise(F.concat(F.substring("block", 1, 1), c))

    joined = metric.radius_join(placed, 1, scratch=scratch)
    near = scratch.keep(joined.select(form("a").alias("a"), form("b").alias("b")).unionByName(_swapped(different.select(F.col("form").alias("s")))).distinct())

    def sure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[x[0] == y[0] and min(len(x), len(y)) > 2 - (len(x) != len(y)) and one_slip(x, y) and (x[0] == "p" or same_unit(x[1:], y[1:], known)) for x, y in zip(pdf.a, pdf.b)]]

    close = scratch.keep(near.mapInPandas(sure, "a string, b string"))
    uneven = close.where("length(a) <> length(b) and a like 'p%'")
    lacking = uneven.select(F.when(F.length("a") < F.length("b"), F.col("a")).otherwise(F.col("b")).alias("form")).distinct()
    people = different.where("form like 'p%' and length(form) > 4").select(F.explode(F.transform(F.sequence(F.lit(3), F.length("form") - 2), lambda k: F.substring(F.col("form"), 1, k))).alias("form")).distinct()
    asked = close.where("a like 'p%'").select(F.explode(F.array("a", "b")).alias("form")).distinct()
    begun = asked.join(people.unionByName(nicknames).distinct(), "form", "left_semi").withColumn("begun", F.lit(True))
    short = asked.join(begun, "form", "left").join(lacking.withColumn("lacks", F.lit(True)), "form", "left").select("form", F.coalesce("begun", F.lit(False)).alias("begun"), F.coalesce("lacks", F.lit(False)).alias("lacks")).where("begun or lacks")
    side = lambda c: short.select(F.col("form").alias(c), F.col("begun").alias(f"begun_{c}"), F.lit(True).alias(f"short_{c}"))
    flagged = close.join(side("a"), "a", "left").join(side("b"), "b", "left")
    shorter_begun = F.when(F.length("a") < F.length("b"), F.col("begun_a")).when(F.length("a") > F.length("b"), F.col("begun_b")).otherwise(True)
    return flagged.where(~F.coalesce(F.col("short_a") & F.col("short_b") & shorter_begun, F.lit(False))).select("a", "b")


def _nicknames(nicks: DataFrame, offers: DataFrame) -> DataFrame:
    """kind, name, form of the names whose ending makes nicknames: a known one, or one that in most names that have it stands
    in the place of the rest of another name of the same family."""
    token = F.concat(F.split("form", r"\|")[1], "ending")
    own = nicks.select("kind", "name", "form", "ending", token.alias("token"))
    by_form = offers.select("form", F.col("ending").alias("token")).groupBy("form").agg(F.min("token").alias("first"), F.max("token").alias("last"))
    answered = F.coalesce((F.levenshtein("first", "token") > 2) | (F.levenshtein("last", "token") > 2), F.lit(False))  # no slip of it
    told = own.join(by_form, "form", "left").groupBy("ending").agg(F.count("*").alias("n"), F.count_if(answered).alias("hits"))
    learned = proper_endings({r.ending: r.n for r in told.where((F.col("hits") >= NICK_NAMES) & (F.col("hits") >= NICK_SHARE * F.col("n"))).toLocalIterator()})
    return own.where(F.col("ending").isin(*NICK_LATIN, *learned)).select("kind", "name", "form").distinct()


def proper_endings(counts: dict[str, int]) -> list[str]:
    """Of endings that contain each other the one that most names with the shorter one have; none longer than that."""
    most = lambda e: [f for f in counts if f[1:] == e and counts[f] >= 0.8 * counts[e]]
    return sorted(e for e in counts if not most(e) and (e[1:] not in counts or counts[e] >= 0.8 * counts[e[1:]]) and len(e) < NICK_LETTERS)


def pairs(grouped: DataFrame) -> DataFrame:
    """kind, name_a, name_b: every two spellings of one entity, name_a < name_b. Groups are the spellings of one entity."""
    a = grouped.select("kind", "entity", F.col("name").alias("name_a"))
    b = grouped.select("kind", "entity", F.col("name").alias("name_b"))
    return a.join(b, ["kind", "entity"]).where("name_a < name_b").select("kind", "name_a", "name_b")
