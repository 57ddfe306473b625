"""Secret scans: fixed patterns, and character Markov models for strings that no pattern knows.

Two models of character pairs are trained, one on random strings and one on ordinary identifiers. A token whose
log-likelihood ratio outweighs the rarity of secrets is a span of its own kind, where no pattern has found one.
Patterns, samples, counts and scores are column expressions; the models reach the driver as counts per character pair.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import let, written

#: Fixed values of the base rules: pattern, the group whose length counts, the least length.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # as long runs only, which finds the same
}
RANDOM = "random"
_ORDER = (*KINDS, RANDOM)
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_SIZE = len(_ALPHABET) + 1  # 0 is the start, and any separator: what follows starts anew, and none is evidence


@dataclass(frozen=True)
class Markov:
    """``least`` and ``most``: characters of a token that is scored as one, longer runs are scored whole too;
    ``odds``: how many ordinary tokens come on a secret; ``sample``: documents at most for which random
    strings are drawn, chosen by a hash of the id; ``drawn``: digests per such document that stand for random strings, beside
    those the patterns find; ``smooth``: added to each count; ``floor``: the share of a row that is even over all characters,
    so that a pair never seen weighs the same however many documents there are. The ordinary class is all identifiers of all
    documents, long ones and parts of paths included, outside base spans."""

    least: int = 20
    odds: float = 1e6
    sample: int = 2000
    drawn: int = 12
    smooth: float = 0.5
    floor: float = 0.01

    @property
    def pattern(self) -> str:
        return rf"[A-Za-z0-9+/_=-]{{{self.least},}}"


_SPAN = "array<struct<start:int,end:int,kind:int,value:string>>"


_PIECE = 64


def _running(values: Column, op: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """What ``op`` makes of each of ``values`` (integers of 0 and above) and all before it.

    An array that grows is copied at each step, so it is done in pieces, and by the same means over the pieces' ends: the time
    is in proportion to the length up to many millions.
    """
    zero = F.lit(0).cast("int")
    if levels == 0:
        step = lambda a, x: let(op(a["last"], x), lambda y: F.struct(y.alias("last"), F.concat(a["out"], F.array(y)).alias("out")))
        return F.aggregate(values, F.struct(zero.alias("last"), F.array().cast("array<int>").alias("out")), step)["out"]

    def whole(pieces: Column) -> Column:
        ends = F.transform(pieces, lambda p: F.element_at(p, -1))
        moved = lambda before: F.transform(pieces, lambda p, k: F.transform(p, lambda x: op(F.coalesce(F.get(before, k - 1), zero), x)))
        return F.flatten(let(_running(ends, op, levels - 1), moved))

    def cut(v: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _PIECE).cast("int"))
        return let(F.transform(firsts, lambda k: _running(F.slice(v, k * _PIECE + 1, _PIECE), op, 0)), whole)

    return let(values, lambda v: F.when(F.size(v) > 0, cut(v)).otherwise(F.array().cast("array<int>")))


def _apart(tokens: Column, base: Column) -> Column:
    """Those of ``tokens`` that meet no span of ``base``: in the order of places, no span that starts before a token's end
    reaches beyond its start."""
    place = lambda s, at, mark, reach: F.struct(at.alias("at"), F.lit(mark).alias("base"), reach.alias("reach"), s.alias("span"))
    places = F.array_sort(
        F.concat(
            F.transform(base, lambda b: place(b, b["start"], 1, b["end"])),
            F.transform(tokens, lambda t: place(t, t["end"], 0, F.lit(0))),
        )
    )

    def met(p: Column) -> Column:
        reached = _running(F.transform(p, lambda x: x["reach"]), F.greatest)
        both = F.arrays_zip(p.alias("p"), reached.alias("reached"))
        free = F.filter(both, lambda x: (x["p"]["base"] == 0) & (x["reached"] <= x["p"]["span"]["start"]))
        return F.transform(free, lambda x: x["p"]["span"])

    return F.when((F.size(tokens) > 0) & (F.size(base) > 0), let(places, met)).otherwise(tokens)


def _spans(text: Column, pattern: str, group: int, least: int, kind: str) -> Column:
    """Leftmost matches in order, as (start, end, kind, value), in code points; without those too short."""

    def placed(gaps: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        matches = F.arrays_zip(F.slice(gaps, 1, F.size(gaps) - 1).alias("gaps"), found.alias("found"), values.alias("values"))
        return let(matches, spans)

    def spans(matches: Column) -> Column:
        ends = _running(F.transform(matches, lambda m: F.length(m["gaps"]) + F.length(m["found"])), lambda a, x: a + x)

        def span(m: Column) -> Column:
            begin = m["ends"] - F.length(m["matches"]["found"])
            kind_ = F.lit(_ORDER.index(kind))
            return F.struct(begin.alias("start"), m["ends"].alias("end"), kind_.alias("kind"), m["matches"]["values"].alias("value"))

        each = F.transform(F.arrays_zip(matches.alias("matches"), ends.alias("ends")), span)
        return F.filter(each, lambda s: F.length(s["value"]) >= least).cast(_SPAN)

    none = F.array().cast(_SPAN)
    return F.when(text.rlike(pattern), let(F.split(text, pattern, -1), placed)).otherwise(none)


def _pairs(token: Column) -> Column:
    """The token's character pairs as numbers, from the start on."""
    codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(_ALPHABET), c))
    return let(codes, lambda c: F.transform(c, lambda x, i: F.coalesce(F.get(c, i - 1), F.lit(0)) * _SIZE + x))


def train(samples: DataFrame, how: Markov) -> list[float]:
    """The log-likelihood ratio of each character pair, from ``samples`` (token, random)."""
    # Each token is taken apart once, however often it occurs.
    tokens = samples.groupBy("random", "token").agg(F.count(F.lit(1)).alias("n"))
    pairs = tokens.select("random", "n", F.explode(_pairs(F.col("token"))).alias("pair"))
    counts = pairs.groupBy("random", "pair").agg(F.sum("n")).collect()
    tables = {kind: [how.smooth] * (_SIZE * _SIZE) for kind in (True, False)}
    for kind, pair, n in counts:
        tables[kind][pair] += n
    logs = {}
    for kind, table in tables.items():
        rows = [sum(table[r * _SIZE + 1 : (r + 1) * _SIZE]) for r in range(_SIZE)]
        even = how.floor / (_SIZE - 1)
        logs[kind] = [math.log((1 - how.floor) * x / rows[i // _SIZE] + even) if i % _SIZE else 0.0 for i, x in enumerate(table)]
    return [a - b for a, b in zip(logs[True], logs[False], strict=True)]


def _score(token: Column, ratios: list[float]) -> Column:
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    return F.aggregate(_pairs(token), F.lit(0.0), lambda s, p: s + F.get(table, p))


def scan(docs: DataFrame, how: Markov = Markov()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, ``base`` and ``added``, arrays of spans (start, end, kind, value).

    Positions count code points, ends are exclusive, spans are in order of start and kind. ``kind`` numbers assign,
    access, hex and random. A null or empty text has no spans; ids may be null or repeat; other columns are not
    looked at. Without documents to train on the models are flat and add nothing.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    share = min(1.0, how.sample / max(1, docs.count()))
    sampled = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    base = F.array_sort(F.concat(*(_spans(text, *rule, kind) for kind, rule in KINDS.items())))
    tokens = _spans(text, how.pattern, 0, how.least, RANDOM)
    apart = _apart(F.col("tokens"), F.col("base"))
    plain = text
    for pattern, _, _ in KINDS.values():
        plain = F.regexp_replace(plain, pattern, " ")
    ordinary = F.regexp_extract_all(plain, F.lit(r"[A-Za-z][A-Za-z0-9_.+/=-]{3,}"), F.lit(0))
    seen = written(
        read.select("doc_id", base.alias("base"), tokens.alias("tokens"), sampled.alias("sampled")).select(
            "doc_id", "base", apart.alias("tokens"), "sampled"
        ),
        "secret-tokens",
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digests = [F.sha2(F.concat(name, F.lit(f"/{k}")), 256) for k in range(how.drawn)]
    drawn = seen.filter("sampled").select(
        F.explode(F.array(*(F.base64(F.unhex(d)) for d in digests), digests[0])).alias("token")
    )
    known = seen.select(F.explode("base").alias("b")).select(F.col("b.value").alias("token"))
    words = read.select(F.explode(ordinary).alias("token"))
    samples = (
        known.unionByName(drawn).withColumn("random", F.lit(True)).unionByName(words.withColumn("random", F.lit(False)))
    )
    ratios = train(samples, how)
    added = F.filter("tokens", lambda t: _score(t["value"], ratios) > math.log(how.odds))
    return seen.select("doc_id", "base", added.alias("added"))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, _ORDER))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def digest(found: DataFrame) -> DataFrame:
    """Per row of ``scan``: doc_id (as it is, null or repeated), counts per kind and the digest of the base spans, all spans as text,
    and n_random. A row without spans has counts of 0, the digest of the empty text and an empty text. No rows give none."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == _ORDER.index(kind))).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_random"),
    )
