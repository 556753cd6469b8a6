"""Secrets in texts: known formats, and character Markov models for all others.

Three formats are found by pattern: ``assign`` (a value given to a password, token or
key), ``access`` (access key ids) and ``hex`` (long lower-case hexadecimal digits).

Two first-order Markov models of characters judge what has no format: one of random
strings, one of ordinary words and identifiers, both counted from labelled samples with
``PRIOR`` added to each count.  A run of at least ``LEAST_RUN`` characters of
``[A-Za-z0-9+/_=-]`` that is ``LOG_ODDS`` (natural logarithm) more likely under the
model of random strings is a span of kind ``markov``, if it overlaps no span of a
known format.

The labelled samples are strings of at most ``SAMPLE`` documents (those with the
smallest hashes of id and text, without texts over ``SAMPLE_CHARS`` characters): random
are their values of known formats and the digests of their texts, written in lower-case
and upper-case hexadecimal and twice in base 64; ordinary are their other words, and the first
``JOINED`` of these joined in the ways in which programs and paths write names.

All work on the texts is in built-in functions, in one stage without a shuffle.  The
models are a table of 81 * 81 log ratios, a literal array in that stage.

Spans are (kind, start, end) in code points, end exclusive, of the whole match; the ones
of a kind do not overlap.

Defined cases: a null text is empty; rows are judged each for itself, so null or
repeated ids make no difference; without a sample both models are even and add nothing;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import written

#: Kind, pattern, group that must have the least length, and that length.
FORMATS = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # the same as longer ones of all runs
]
LEAST_RUN, LEAST_DISTINCT = 16, 8
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}"
WORD = r"[A-Za-z0-9+/_=-]{4,}"
#: Natural logarithm of how much likelier a run is under the model of random strings.
LOG_ODDS = 14.0
EVEN = 0.2
SAMPLE, SAMPLE_CHARS, JOINED = 2000, 20_000, 12
#: Code of the character before the first one, codes in all, and characters that a run can have.
_START, _CODES, _USED = ord("+") - 1, ord("z") - ord("+") + 2, 67


def _running_sums(numbers: Column, n: Column) -> Column:
    """Sums of an array of ``n`` numbers up to each, by doubling the reach: n log n additions."""

    def reach(i: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), i)

    def doubled(sums: Column, i: Column) -> Column:
        moved = F.slice(F.concat(F.array_repeat(F.lit(0), reach(i)), sums), F.lit(1), n)
        return F.zip_with(sums, moved, lambda a, b: a + b)

    return F.reduce(F.filter(F.sequence(F.lit(0), F.lit(30)), lambda i: reach(i) < n), numbers, doubled)


def _placed(text: Column, pattern: str, found: Column, kind: str, order: int) -> Column:
    """Spans (start, order, end, kind, text) of the matches ``found`` of a pattern in a text."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda gap, match: gap + F.length(match))
    spans = F.zip_with(
        _running_sums(steps, F.size(found)),
        found,
        lambda end, match: F.struct(
            (end - F.length(match)).alias("start"),
            F.lit(order).alias("order"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            match.alias("match"),
        ),
    )
    return F.when(F.size(found) > 0, spans).otherwise(
        F.array().cast("array<struct<start: int, order: int, end: int, kind: string, match: string>>")
    )


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _value(match: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(match, pattern, group) if group else match


def _long_spans(spans: Column, pattern: str, group: int, least: int) -> Column:
    return F.filter(spans, lambda span: F.length(_value(span["match"], pattern, group)) >= least)


def _long_values(text: Column, pattern: str, group: int, least: int) -> Column:
    values = F.transform(_matches(text, pattern), lambda match: _value(match, pattern, group))
    return F.filter(values, lambda value: F.length(value) >= least)


def with_formats(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with the spans of each known format in a column of its name."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = docs.withColumns({f"found_{kind}": _matches(text, pattern) for kind, pattern, *_ in FORMATS})
    spans = {}
    for order, (kind, pattern, group, least) in enumerate(FORMATS):
        placed = _placed(text, pattern, F.col(f"found_{kind}"), kind, order)
        spans[kind] = _long_spans(placed, pattern, group, least)
    return found.withColumns(spans).drop(*(f"found_{kind}" for kind, *_ in FORMATS))


def _steps(string: Column) -> Column:
    """Numbers of the transitions in a string, the one from its start included."""
    last = F.lit(_CODES - 1)
    codes = F.transform(F.split(string, "", -1), lambda c: F.greatest(F.least(F.ascii(c) - _START, last), F.lit(0)))
    before = F.slice(F.concat(F.array(F.lit(0)), codes), F.lit(1), F.size(codes))
    return F.zip_with(before, codes, lambda a, b: a * _CODES + b)


def labelled_samples(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(string, random) from a bounded sample of the documents."""
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # About four times as many as are taken go to the task that orders them.
    every = max(1, texts.count() // (4 * SAMPLE))
    hashed = F.xxhash64("id", "text")
    short = (F.length("text") <= SAMPLE_CHARS) & (F.pmod(hashed, F.lit(every)) == 0)
    few = texts.where(short).orderBy(hashed, "id", "text").limit(SAMPLE).select("text")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = written(few.repartition(partitions), "secret-sample")
    values, left = [], F.col("text")
    for _, pattern, group, least in FORMATS:
        values.append(_long_values(F.col("text"), pattern, group, least))
        left = F.regexp_replace(left, pattern, " ")
    short_digest, digest = F.sha2("text", 256), F.sha2("text", 512)
    as_64 = [F.regexp_replace(F.base64(F.unhex(d)), "[\r\n=]", "") for d in (digest, F.sha2(digest, 512))]
    random = F.concat(*values, F.array(short_digest, F.upper(F.sha2(short_digest, 256)), *as_64))
    rows = sample.select(random.alias("random"), _matches(left, WORD).alias("words"))
    some = F.slice("words", 1, JOINED)
    camel = F.replace(F.initcap(F.array_join(some, " ")), F.lit(" "), F.lit(""))
    names = F.array(*(F.array_join(some, mark) for mark in "_-/"), F.upper(F.array_join(some, "_")), camel)
    ordinary = rows.select(F.explode(F.concat("words", names)).alias("string"), F.lit(False).alias("random"))
    return rows.select(F.explode("random").alias("string"), F.lit(True).alias("random")).unionByName(ordinary)


def train(samples: DataFrame) -> DataFrame:
    """(step, log_ratio) of every transition between two characters, random against ordinary."""
    steps = samples.where("string <> ''").select("random", F.explode(_steps(F.col("string"))).alias("step"))
    counted = steps.groupBy("step").agg(
        F.count_if("random").alias("n_random"), F.count_if(~F.col("random")).alias("n_ordinary")
    )
    every = samples.sparkSession.range(_CODES * _CODES).select(F.col("id").cast("int").alias("step"))
    # 81 * 81 rows at any size of the sample.
    all_steps = every.join(counted, "step", "left").na.fill(0, ["n_random", "n_ordinary"])
    before = (F.col("step") / _CODES).cast("int")
    totals = all_steps.groupBy(before.alias("before")).agg(
        F.sum("n_random").alias("all_random"), F.sum("n_ordinary").alias("all_ordinary")
    )

    def log_share(label: str) -> Column:
        # Of a character that was never seen, any may follow.
        counted = F.coalesce(F.col(f"n_{label}") / F.nullif(F.col(f"all_{label}"), F.lit(0)), F.lit(1 / _USED))
        return F.log((1 - EVEN) * counted + EVEN / _USED)

    ratio = log_share("random") - log_share("ordinary")
    joined = all_steps.withColumn("before", before).join(totals, "before")
    return written(joined.select("step", F.round(ratio, 4).alias("log_ratio")), "secret-model")


def as_array(model: DataFrame) -> Column:
    """The model as a constant array, by step."""
    rows = sorted(model.select("step", "log_ratio").collect())
    return F.split(F.lit(",".join(str(ratio) for _, ratio in rows)), ",").cast("array<double>")


def log_odds(string: Column, model: Column) -> Column:
    """Log-likelihood ratio of a string of ASCII characters; ``model`` is the array of log ratios."""
    return F.reduce(
        F.transform(_steps(string), lambda step: F.element_at(model, step + 1)),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def scan(
    docs: DataFrame, model: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document: id, and its spans (start, order, end, kind, match), those of known formats first and all."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    array = as_array(model)
    rows = with_formats(docs.select(F.col(id_column).alias("id"), text.alias("text")))
    base = F.array_sort(F.concat(*(kind for kind, *_ in FORMATS)))
    rows = rows.select("id", "text", base.alias("base"), _matches(F.col("text"), RUN).alias("runs"))
    runs = _placed(F.col("text"), RUN, F.col("runs"), "markov", len(FORMATS))

    def is_secret(run: Column) -> Column:
        known = F.exists("base", lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
        varied = F.size(F.array_distinct(F.split(run["match"], "", -1))) >= LEAST_DISTINCT
        return ~known & varied & (log_odds(run["match"], array) >= LOG_ODDS)

    rows = rows.select("id", "base", F.filter(runs, is_secret).alias("more"))
    return rows.select(F.col("id").alias(id_column), "base", F.array_sort(F.concat("base", "more")).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, parted by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_digests(docs: DataFrame, model: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, number of spans of each known format, their digest, and all spans as text."""
    found = scan(docs, model, id_column, text_column)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        id_column,
        *(count(kind) for kind, *_ in FORMATS),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
