"""Licence scan by a positional index of rare words, with DataFrame functions only.

The templates (short phrases and notices, a bounded parameter) say which words stand where. ``frequencies`` counts over
all documents in how many each template word occurs; ``index`` keeps of each template its rarest words with their
places. A document looks its words up in that index: each place of an indexed word proposes where the template would
start, the places of the template's other rare words are compared at the same start, and a notice is accepted if enough
of them agree and its mandatory key phrases stand inside its bounds. A phrase is accepted only with all its words.

If a template needs ``m`` of its ``r`` rare words in place, at least one of its ``r - m + 1`` rarest is in place in every
match, so only those propose starts and no match is lost. All of it happens inside a document's row: the one shuffle
carries the counts of the template words, and nothing that grows with the documents reaches the driver.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands between words once A-Z became a-z: ASCII other than letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Most templates and most words of one; they bound the literals that every task carries.
MOST_TEMPLATES, MOST_WORDS = 500, 500


class Template(NamedTuple):
    """``words`` in their places; a phrase (``exact``) stands as it is, a notice may differ but for its ``keys``."""

    label: str
    words: tuple[str, ...]
    exact: bool
    keys: tuple[tuple[str, ...], ...] = ()


def split_words(text: str) -> tuple[str, ...]:
    return tuple(w for w in re.split(BETWEEN, text.translate(str.maketrans(UPPER, LOWER))) if w)


def phrase(label: str, text: str) -> Template:
    return Template(label, split_words(text), True)


def notice(label: str, text: str, *keys: str) -> Template:
    return Template(label, split_words(text), False, tuple(split_words(k) for k in keys))


class Entry(NamedTuple):
    """A template in the index: its rare words and their places, rarest first, and how many must be in place."""

    template: Template
    anchors: tuple[tuple[str, int], ...]
    need: int


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BETWEEN), "")


def frequencies(docs: DataFrame, templates: list[Template], *, text_col: str = "text") -> dict[str, int]:
    """In how many rows of ``docs`` each template word occurs (all rows count; at most the template words come back)."""
    if len(templates) > MOST_TEMPLATES or any(len(t.words) > MOST_WORDS for t in templates):
        raise ValueError(f"at most {MOST_TEMPLATES} templates of {MOST_WORDS} words")
    vocabulary = sorted({w for t in templates for w in t.words})
    if not vocabulary:
        return {}
    found = docs.select(F.array_intersect(words_of(F.col(f"`{text_col}`")), F.lit(vocabulary)).alias("w"))
    rows = found.select(F.explode("w").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r.w: r.n for r in rows}


def index(templates: list[Template], frequency: dict[str, int], *, anchors: int = 4, agree: int = 3) -> list[Entry]:
    """Of each template its ``anchors`` rarest word places (ties: by word, then place); a phrase keeps all its words.

    A notice needs ``agree`` of them in place (all, if it has fewer). Words of no document are left out, and so are
    templates that cannot match any more.
    """
    entries = []
    for t in templates:
        places = sorted((frequency.get(w, 0), w, i) for i, w in enumerate(t.words))
        if t.exact:
            if places and places[0][0]:
                entries.append(Entry(t, tuple((w, i) for _, w, i in places), len(places)))
            continue
        known = [(w, i) for n, w, i in places if n][:anchors]
        need = min(agree, len(t.words))
        if known and len(known) >= need:
            entries.append(Entry(t, tuple(known), need))
    return entries


MATCH = "array<struct<label:string,exact:boolean,start:int,in_place:int,anchors:int>>"
#: A candidate is one number: the template above these bits, the start (which may lie before the text) below.
START_BITS = 40
#: No template start lies further before the text than this.
BEFORE = 1 << 16


def scan(docs: DataFrame, entries: list[Entry], *, id_col: str = "doc_id", text_col: str = "text",
         slack: int = 2) -> DataFrame:
    """Where the templates of ``entries`` stand in every row of ``docs``.

    Returns ``doc_id``, ``n_words`` and ``matches``: label, exact, start (word number; a notice whose first words are
    missing may start before 0), in_place and anchors (how many of its rare words stand in place, and of how many), by
    template order and start. Key phrases may stand up to ``slack`` words outside a notice's bounds. A null text has no
    words. Rows with a null or repeated id are rows like any other, other columns are not looked at, and an empty table
    gives no rows.
    """
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), words_of(F.col(f"`{text_col}`")).alias("w"))
    size = F.size("w").cast("long").alias("n_words")
    if not entries:
        return base.select("doc_id", size, F.lit(None).cast(MATCH).alias("none")) \
            .select("doc_id", "n_words", F.coalesce("none", F.array().cast(MATCH)).alias("matches"))

    lookups = [(w, t, i) for t, e in enumerate(entries) for w, i in e.anchors[:len(e.anchors) - e.need + 1]]
    tokens = sorted({w for w, _, _ in lookups})
    postings = F.array(*[F.struct(F.lit(w).alias("w"), F.lit((t << START_BITS) + BEFORE - i).cast("long").alias("at"))
                     for w, t, i in lookups])
    table = F.array(*[F.struct(
        F.lit(e.template.label).alias("label"), F.lit(e.template.exact).alias("exact"), F.lit(e.need).alias("need"),
        F.lit(len(e.template.words)).alias("size"),
        F.array(*[F.struct(F.lit(w).alias("w"), F.lit(i).alias("i")) for w, i in e.anchors]).alias("anchors"),
        F.array(*[F.lit(list(k)) for k in e.template.keys]).cast("array<array<string>>").alias("keys"))
        for e in entries])

    places = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get(F.col("w"), i).isin(tokens))
    base = base.select("doc_id", "w", F.when(F.size("w") > 0, places).otherwise(F.array().cast("array<int>")).alias("p"))
    starts = F.transform("p", lambda i: F.transform(
        F.filter(postings, lambda p: p["w"] == F.get(F.col("w"), i)), lambda p: p["at"] + i))
    base = base.select("doc_id", "w", F.array_sort(F.array_distinct(F.flatten(starts))).alias("c"))

    def at(c: Column) -> Column:
        t = F.get(table, F.shiftright(c, START_BITS).cast("int"))
        start = (c.bitwiseAND(F.lit((1 << START_BITS) - 1)) - BEFORE).cast("int")
        in_place = F.size(F.filter(t["anchors"], lambda a: F.get(F.col("w"), start + a["i"]) == a["w"]))
        return F.struct(t.alias("t"), start.alias("start"), in_place.alias("in_place"))

    def has_keys(x: Column) -> Column:
        def stands(key: Column, s: Column) -> Column:
            return F.forall(F.sequence(F.lit(0), F.size(key) - 1), lambda j: F.coalesce(
                F.get(F.col("w"), s + j) == F.get(key, j), F.lit(False)))

        bounds = F.sequence(x["start"] - slack, x["start"] + x["t"]["size"] - 1 + slack)
        return F.forall(x["t"]["keys"], lambda key: F.exists(bounds, lambda s: stands(key, s)))

    found = F.filter(F.transform("c", at), lambda x: (x["in_place"] >= x["t"]["need"]) & has_keys(x))
    match = F.transform(found, lambda x: F.struct(
        x["t"]["label"].alias("label"), x["t"]["exact"].alias("exact"), x["start"].alias("start"),
        x["in_place"].alias("in_place"), F.size(x["t"]["anchors"]).alias("anchors")))
    return base.select("doc_id", size, match.alias("matches"))
