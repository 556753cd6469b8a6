"""URL rules judged by a Bloom filter cascade, in DataFrame expressions only.

The keys are what a url could be listed under: each suffix of its host at a
label boundary, joined with each prefix of its path that is as long as some
rule's path, once per action.  The key universe is all distinct keys of the
corpus.  Level 1 of the cascade encodes the listed keys, level 2 the keys of the
universe that level 1 wrongly accepts, level 3 the listed keys that level 2
wrongly accepts, and so on until a level accepts nothing wrongly.  A key of the
universe is listed exactly if the first level that refuses it is an even one (or
if the number of levels is odd and all accept it).  A url is then judged from the
cascade alone, without a join; the bits are a constant of the plan.

Defined cases: a null url or one without ``://`` has an empty host and path and
fits no rule; of several fitting rules the longest string wins, then the longer
host, then ``allow``; a url that no key of the cascade lists is allowed; rules
repeated are one rule; rows repeated are judged each; columns of the input other
than id and url are ignored.  A list of any length is dealt by hash into cascades of
about ``KEYS`` rules, one pass over the urls for each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules of a cascade, about.
KEYS = 1 << 19
#: A level's bits travel with each task; KEYS keys stay below this.
MAX_WORDS = 1 << 21


@dataclass(frozen=True)
class UrlRule:
    action: str
    host: str
    path: str


#: The rules of the production query.
RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


@dataclass(frozen=True)
class Level:
    """The bits of one Bloom filter, as a constant; bit p is bit p % 8 of byte p / 8 xor 7."""

    bits: bytes
    hashes: int


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path as the rules see them."""
    known = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    rest = F.substr(url, F.locate("://", url) + 3)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def candidate_keys(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """Array of structs (host, path): everything the url could be listed under."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    lengths = F.filter(
        F.array(*[F.lit(n) for n in path_lengths]), lambda n: n <= F.length(path)
    )
    return F.flatten(
        F.transform(
            F.filter(suffixes, lambda s: s != ""),
            lambda s: F.transform(
                lengths,
                lambda n: F.struct(s.alias("host"), F.substring(path, F.lit(1), n).alias("path")),
            ),
        )
    )


def _key(action: Column | str, host: Column, path: Column) -> Column:
    action = F.lit(action) if isinstance(action, str) else action
    return F.concat_ws("\u0001", action, host, path)


def _positions(key: Column, number: int, n_bits: int, hashes: int) -> list[Column]:
    """Bit positions by double hashing."""
    first = F.pmod(F.xxhash64(F.lit(2 * number), key), F.lit(n_bits))
    step = F.pmod(F.xxhash64(F.lit(2 * number + 1), key), F.lit(n_bits - 1)) + 1
    return [F.pmod(first + F.lit(i).cast("long") * step, F.lit(n_bits)) for i in range(hashes)]


def _accepts(key: Column, number: int, level: Level) -> Column:
    """Whether all bits of the key are set in the level."""
    bits = F.lit(level.bits)

    def is_set(p: Column) -> Column:
        at = F.shiftright(p, 3).bitwiseXOR(F.lit(7).cast("long")).cast("int") + 1
        byte = F.ascii(F.decode(F.substring(bits, at, F.lit(1)), "ISO-8859-1"))
        return F.getbit(byte, p.bitwiseAND(F.lit(7).cast("long")).cast("int")) == 1

    positions = _positions(key, number, 8 * len(level.bits), level.hashes)
    return reduce(Column.__and__, map(is_set, positions))


def _level(keys: DataFrame, number: int, n: int, rate: float) -> Level:
    """Encode ``n`` keys so that a foreign key is accepted with probability ``rate``."""
    hashes = max(1, round(-math.log2(rate)))
    n_words = max(1, math.ceil(n * hashes / math.log(2) / 64))
    if n_words > MAX_WORDS:
        raise ValueError(f"a filter of {n} keys needs {n_words} words, more than {MAX_WORDS}")
    at = F.explode(F.array(*_positions(F.col("key"), number, 64 * n_words, hashes)))
    one = F.expr("shiftleft(1L, CAST(p & 63L AS INT))")
    set_ = keys.select(at.alias("p")).select(F.shiftright("p", 6).alias("word"), one.alias("bits"))
    every = keys.sparkSession.range(n_words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = set_.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # At most MAX_WORDS rows meet here, whatever the size of the corpus.
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    digits = F.transform(ordered, lambda w: F.lpad(F.hex(w["bits"]), 16, "0"))
    bits = words.agg(F.unhex(F.array_join(digits, "")).alias("bits")).first()["bits"]
    return Level(bytes(bits), hashes)


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels that separate the listed keys from all other keys of the universe.

    ``listed`` and ``universe`` have a column ``key``.  Both may repeat keys;
    the universe need not hold the listed ones.  With s foreign and r listed
    keys the first level accepts r / (2 s) of the foreign keys or half of them,
    each later one half of what is left, so the whole takes about
    r log2(s / r) bits and log2(r) levels.  Only the keys that the previous
    level of the same side left over are read again.
    """
    tagged = (
        universe.select("key", F.lit(False).alias("in_list"))
        .unionByName(listed.select("key", F.lit(True).alias("in_list")))
        .groupBy("key")
        .agg(F.max("in_list").alias("in_list"))
    )
    keys = written(tagged, "bloom-universe", partition_by="in_list")
    wanted, others = keys.where("in_list").select("key"), keys.where("NOT in_list").select("key")
    n_wanted, n_others = wanted.count(), others.count()
    levels: list[Level] = []
    while n_wanted:
        rate = min(0.5, n_wanted / (2 * n_others)) if n_others and not levels else 0.5
        levels.append(level := _level(wanted, len(levels), n_wanted, rate))
        wrong = others.where(_accepts(F.col("key"), len(levels) - 1, level))
        wrong = written(wrong, "bloom-wrong")
        wanted, others, n_wanted, n_others = wrong, wanted, wrong.count(), n_wanted
    return levels


def is_listed(key: Column, levels: Sequence[Level]) -> Column:
    """Exact membership of a key of the universe."""
    answer = F.lit(len(levels) % 2 == 1)
    for number in reversed(range(len(levels))):
        answer = F.when(~_accepts(key, number, levels[number]), F.lit(number % 2 == 1)).otherwise(answer)
    return answer


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    keys_a_cascade: int = KEYS,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    ``rules`` has columns action, host, path.
    """
    lengths = sorted(r["n"] for r in rules.select(F.length("path").alias("n")).distinct().collect())
    host, path = url_parts(F.col(url_column))
    parts = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    candidate = candidate_keys(F.col("host"), F.col("path"), lengths)

    actions = ("allow", "block")
    spread = parts.select(F.explode(candidate).alias("c")).distinct()
    universe = spread.select(
        F.explode(
            F.array(*[_key(a, F.col("c.host"), F.col("c.path")) for a in actions])
        ).alias("key")
    )

    def hits(action: str, levels: Sequence[Level]) -> Column:
        fitting = F.filter("candidate", lambda c: is_listed(_key(action, c["host"], c["path"]), levels))
        return F.transform(
            fitting,
            lambda c: F.struct(
                (F.length(c["host"]) + F.length(c["path"])).alias("n"),
                F.length(c["host"]).alias("n_host"),
                F.lit(action == "allow").alias("allowed"),
                F.concat(c["host"], c["path"]).alias("rule"),
            ),
        )

    keys = rules.select(_key(F.col("action"), F.col("host"), F.col("path")).alias("key"))
    slices = max(1, math.ceil(keys.count() / keys_a_cascade))
    for number in range(slices):
        listed = keys.where(F.pmod(F.xxhash64("key"), F.lit(slices)) == number) if slices > 1 else keys
        levels = build_cascade(listed, universe)
        best = F.array_max(F.concat(*[hits(a, levels) for a in actions]))
        if number:
            best = F.array_max(F.array(F.col("best"), best))
        parts = parts.withColumn("candidate", candidate).withColumn("best", best).drop("candidate")
        if number < slices - 1:
            parts = written(parts, "bloom-judged")
    verdict = F.when(F.coalesce(F.col("best.allowed"), F.lit(True)), "allow").otherwise("block")
    return parts.select(
        F.col(id_column), "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict")
    )


def rules_table(spark, rules: Sequence[UrlRule] = RULES) -> DataFrame:
    rows = [(r.action, r.host, r.path) for r in rules]
    return spark.createDataFrame(rows, "action string, host string, path string")
