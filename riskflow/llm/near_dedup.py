"""Near-duplicates by MinHash with tensored banding.

A document is its set of distinct word 5-grams.  Two collections of ``HALVES``
half keys are formed, each half key from ``ROWS`` minhashes; a table key is a half
key of the first collection with one of the second.  So HALVES ** 2 tables need
only 2 * HALVES * ROWS minhashes, about the square root of what as many
independent tables of that width would take.  A pair of similarity s meets in some
table with probability (1 - (1 - s ** ROWS) ** HALVES) ** 2: 0.999 at 0.75, 0.16 at
0.4.

Documents with the same set are one class, represented by their smallest id; only
representatives go on.  No table is ever laid out: rows are dealt out by the first
half key, if another document has it too, and the second halves are held against each
other where two such documents are compared.

Links are verified on the full sets.  First each member of a group, the documents
with one first half key, is compared with the group's leader, the document with the
most company in all its groups.  The links found join most of a group.  A group with
members in different components is then cut into blocks, those of its largest
component apart from all others, and every pair of blocks that can hold a missing link
goes to one task.  It picks the pairs that meet in a table, in different components and
with fitting sizes, each in the first group they share, counts their common shingles
through an inverted list of the block, and gives the links that join components.
So every candidate link that could change a component is looked at, while pairs are
neither spelled out as rows nor sent with their texts.

Half keys with very many documents are cut into parts; each part has a leader of
its own, and these are compared with one of them.

Defined cases: a text without a word, null included, has an empty set and is
linked with nothing; one with fewer than five words has its whole sequence as its
only element; rows that repeat an id are the same document; a null id is linked
with nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import forget, give_back, salted_join, semi_join_ids, text_chunks, written
from riskflow.llm.components import components

SHINGLE = 5
HALVES, ROWS = 20, 4
#: Documents of a block, and their shingles, on average at most.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 200_000
#: Least intersection as a share of the union, in per cent.
SIMILARITY = 75

_RNG = np.random.default_rng(5)
_PLACES = _RNG.integers(1 << 63, size=SHINGLE, dtype=np.uint64) | np.uint64(1)
_SIZES = _RNG.integers(1 << 63, size=SHINGLE + 1, dtype=np.uint64)
_MASKS = _RNG.integers(1 << 63, size=2 * HALVES * ROWS, dtype=np.uint64)
_FACTORS = _RNG.integers(1 << 63, size=2 * HALVES * ROWS, dtype=np.uint64) | np.uint64(1)


class WordHashes(dict):
    """64-bit hash of each word met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = xxhash.xxh3_64_intdigest(word)
        return number


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_sets(texts: list[str | None], hashes: dict[bytes, int] | None = None) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word 5-grams."""
    hashes = WordHashes() if hashes is None else hashes
    cut = [(text or "").encode().lower().split() for text in texts]
    sets = []
    for words in cut:
        n = len(words)
        if not n:
            sets.append(np.zeros(0, np.uint64))
            continue
        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
        width = min(n, SHINGLE)
        total = np.full(n - width + 1, _SIZES[width], np.uint64)
        for k in range(width):
            total += h[k : n - width + 1 + k] * _PLACES[k]
        sets.append(np.unique(_mixed(total)))
    return sets


def half_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """HALVES keys of either collection for each set, none of which may be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    keys = np.zeros((2 * HALVES, len(sets)), np.uint64)
    for i, (mask, factor) in enumerate(zip(_MASKS, _FACTORS, strict=True)):
        least = np.minimum.reduceat((flat ^ mask) * factor, starts)
        keys[i // ROWS] = _mixed(keys[i // ROWS] * np.uint64(31) + least)
    return keys[:HALVES].T.view(np.int64), (keys[HALVES:].T >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _lists(values: np.ndarray, present: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as lists, null where absent."""
    ends = np.concatenate([[0], np.cumsum(present * HALVES)]).astype(np.int32)
    mask = np.append(~present, False)
    return pa.ListArray.from_arrays(pa.array(ends, mask=mask), pa.array(values.ravel(), kind))


def signatures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, digest of the set, first and second half keys."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # of earlier stages
        for batch in batches:
            for some, texts in text_chunks(batch.column(1)):
                sets = shingle_sets(texts)
                present = np.array([len(s) > 0 for s in sets])
                full = [s for s in sets if len(s)]
                none = np.zeros((0, HALVES), np.int64), np.zeros((0, HALVES), np.int32)
                first, second = half_keys(full) if full else none
                digests = [hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[some],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.binary()),
                        _lists(first, present, pa.int64()),
                        _lists(second, present, pa.int32()),
                    ],
                    ["id", "n_shingles", "digest", "first", "second"],
                )
            del batch
        give_back()

    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        signed, f"id {id_type}, n_shingles bigint, digest binary, first array<bigint>, second array<int>"
    )


def _classes(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (id, n_shingles, rep, and the half keys of representatives), and classes (rep, n)."""
    usable = F.col("digest").isNotNull() & F.col("id").isNotNull()
    same = signed.where(usable).groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("rep"))
    same = written(same.where("n > 1"), "near-classes")
    rep = F.when(usable, F.coalesce("rep", "id")).otherwise(F.col("id"))
    leads = usable & (F.col("id") == F.coalesce("rep", "id"))
    members = salted_join(signed, same, ["digest"], "n", "id", "left").select(
        "id",
        "n_shingles",
        rep.alias("rep"),
        F.when(leads, F.col("first")).alias("first"),
        F.when(leads, F.col("second")).alias("second"),
    )
    return written(members, "near-members"), same.select("rep", "n")


def _groups(members: DataFrame) -> DataFrame:
    """(i, half, part, split, id, size, leader) for each representative whose first half key i others have too.

    ``split`` tells that the group has several parts, each with a leader: the
    document with the most others over all its groups, which in a family of
    copies is one near the common origin.
    """
    halves = members.where(F.col("first").isNotNull()).select(
        "id", F.col("n_shingles").alias("size"), F.posexplode("first").alias("i", "half")
    )
    shared = written(halves.groupBy("i", "half").agg(F.count("*").alias("n")).where("n > 1"), "near-halves")
    met = salted_join(halves, shared, ["i", "half"], "n", "id", keep_parts=True).select(
        "i", "half", F.col("_part").alias("part"), (F.col("_parts") > 1).alias("split"), "id", "size", "n"
    )
    met = written(met, "near-met")
    degrees = met.groupBy("id").agg(F.sum("n").alias("degree"))
    rank = F.struct("degree", (-F.col("id")).alias("first"))
    leader = F.max_by("id", rank).over(Window.partitionBy("i", "half", "part"))
    led = met.drop("n").join(degrees, "id").withColumn("leader", leader).drop("degree")
    led = written(led, "near-groups")
    forget(met, shared)
    return led


def _to_leaders(groups: DataFrame) -> DataFrame:
    """Pairs (a, b): the leader and a member of its group or part; and the leaders of parts."""
    # As many rows of a group as it has parts.
    leaders = groups.where("split").select("i", "half", "leader").distinct()
    top = F.min("leader").over(Window.partitionBy("i", "half"))
    between = leaders.select(top.alias("a"), F.col("leader").alias("b"))
    pairs = groups.select(F.col("leader").alias("a"), F.col("id").alias("b")).unionByName(between)
    return pairs.where("a <> b").distinct()


def _linked(common: np.ndarray | int, total: np.ndarray | int) -> np.ndarray | bool:
    """Whether ``common`` elements are enough for two sets of ``total`` elements together."""
    return 100 * common >= SIMILARITY * (total - common)


def _compared(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that meet in a table and are linked.  ``docs`` is a table (id, second, text)."""
    pairs = written(pairs, "near-pairs")
    counted = pairs.groupBy("a").agg(F.count("*").alias("n"))
    of_a = counted.join(docs, counted["a"] == docs["id"]).select(
        "a", "n", F.col("second").alias("second_a"), F.col("text").alias("text_a")
    )
    of_a = written(of_a, "near-texts-a")
    with_b = pairs.join(docs, pairs["b"] == docs["id"]).select(
        "a", "b", F.col("second").alias("second_b"), F.col("text").alias("text_b")
    )

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known, hashes = None, None, WordHashes()
        for batch in batches:
            if len(hashes) > 300_000:
                hashes = WordHashes()
            meet = (_matrix(batch.column("second_a")) == _matrix(batch.column("second_b"))).any(axis=1)
            linked = np.zeros(batch.num_rows, bool)
            a_ids, a_texts, b_texts = (batch.column(name) for name in ("a", "text_a", "text_b"))
            for row in np.flatnonzero(meet).tolist():
                if a_ids[row] != last:
                    last, known = a_ids[row], shingle_sets([a_texts[row].as_py()], hashes)[0]
                other = shingle_sets([b_texts[row].as_py()], hashes)[0]
                common = len(np.intersect1d(known, other, assume_unique=True))
                linked[row] = _linked(common, len(known) + len(other))
            yield batch.select(["a", "b"]).filter(pa.array(linked))
        hashes.clear()
        give_back()

    id_type = pairs.schema["a"].dataType.simpleString()
    both = salted_join(with_b, of_a, ["a"], "n", "b")
    both = both.select("a", "b", "second_a", "second_b", "text_a", "text_b")
    links = written(both.mapInArrow(verified, f"a {id_type}, b {id_type}"), "near-links")
    forget(pairs, of_a)
    return links


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of HALVES numbers as rows."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), HALVES)


def _sets(docs: DataFrame) -> DataFrame:
    """(id, first, second, elements) of documents (id, first, second, text): the sorted set as bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, texts in text_chunks(batch.column("text")):
                raw = [s.tobytes() for s in shingle_sets(texts)]
                rows = batch.slice(some.start, some.stop - some.start)
                columns = [rows.column(name) for name in ("id", "first", "second")]
                names = ["id", "first", "second", "elements"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(raw, pa.binary())], names)
            del batch
        give_back()

    id_type = docs.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, first array<bigint>, second array<int>, elements binary"
    return written(docs.select("id", "first", "second", "text").mapInArrow(cut, schema), "near-sets")


def _block_pairs(groups: DataFrame, joined: DataFrame) -> DataFrame:
    """(i, half, p, q, block, id, component) of groups whose members are in different components.

    Blocks 0 to n_main - 1 hold the largest component, the others all other members.
    Two blocks of the former are never paired.
    """
    placed = groups.join(joined, "id", "left").select(
        "i", "half", "id", "size", F.coalesce("component", "id").alias("component")
    )
    placed = written(placed, "near-placed")
    counted = placed.groupBy("i", "half", "component").agg(F.count("*").alias("c"), F.sum("size").alias("s"))
    largest = F.struct("c", (-F.col("component")).alias("first"))
    mixed = counted.groupBy("i", "half").agg(
        F.sum("c").alias("n"),
        F.sum("s").alias("shingles"),
        F.max_by("component", largest).alias("main"),
        F.max(largest)["c"].alias("in_main"),
        F.max_by("s", largest).alias("main_shingles"),
    )

    def blocks(docs: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(docs / BLOCK_DOCS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")

    mixed = mixed.where("n > in_main").select(
        "i",
        "half",
        "n",
        "main",
        blocks(F.col("in_main"), F.col("main_shingles")).alias("n_main"),
        blocks(F.col("n") - F.col("in_main"), F.col("shingles") - F.col("main_shingles")).alias("n_rest"),
    )
    mixed = written(mixed, "near-mixed")
    open_ = salted_join(placed, mixed, ["i", "half"], "n", "id")
    hashed = F.xxhash64("id")
    in_main = F.col("component") == F.col("main")
    block = F.when(in_main, F.pmod(hashed, F.col("n_main"))).otherwise(
        F.col("n_main") + F.pmod(hashed, F.col("n_rest"))
    ).cast("int")
    first_rest, last_rest = F.col("n_main"), F.col("n_main") + F.col("n_rest") - 1
    others = F.when(in_main, F.sequence(first_rest, last_rest)).otherwise(F.sequence(F.lit(0), last_rest))
    paired = open_.withColumn("block", block).withColumn("other", F.explode(others))
    return paired.select(
        "i", "half", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
        "block", "id", "component",
    )


def block_links(
    i: int, left: np.ndarray, right: np.ndarray, components: np.ndarray, first: np.ndarray, second: np.ndarray,
    sets: list[np.ndarray],
) -> Iterator[tuple[int, int]]:
    """Links between the documents at ``left`` and ``right``, as many as it takes to join components.

    Looked at are pairs that meet in a table (i, j) but not in a first half before i.
    With ``left`` and ``right`` the same, each pair is looked at once.
    """
    wanted = components[left][:, None] != components[right][None, :]
    if left is right:
        wanted = np.triu(wanted)
    sizes = np.array([len(s) for s in sets], np.int64)
    small = np.minimum(sizes[left][:, None], sizes[right][None, :])
    large = np.maximum(sizes[left][:, None], sizes[right][None, :])
    wanted &= 100 * small >= SIMILARITY * large
    for k in range(i):
        wanted &= first[left, k][:, None] != first[right, k][None, :]
    meet = np.zeros_like(wanted)
    for k in range(HALVES):
        meet |= second[left, k][:, None] == second[right, k][None, :]
    wanted &= meet
    columns = np.flatnonzero(wanted.any(axis=0))
    if not len(columns):
        return
    held = [sets[d] for d in right[columns].tolist()]
    elements = np.concatenate(held)
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], np.repeat(np.arange(len(held)), [len(s) for s in held])[order]
    root: dict[object, object] = {}

    def find(x):
        while x in root:
            x = root[x]
        return x

    for a in np.flatnonzero(wanted.any(axis=1)).tolist():
        mine = sets[left[a]]
        low = np.searchsorted(elements, mine, "left")
        n = np.searchsorted(elements, mine, "right") - low
        places = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(owner[places], minlength=len(held))
        linked = wanted[a, columns] & _linked(common, len(mine) + sizes[right[columns]])
        for b in right[columns[linked]].tolist():
            x, y = find(components[left[a]].item()), find(components[b].item())
            if x != y:
                root[x] = y
                yield int(left[a]), b


def _across(groups: DataFrame, joined: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between members of a group that are in different components."""
    rows = written(_block_pairs(groups, joined), "near-open")
    ids = rows.select("id").distinct()
    sets = _sets(docs.join(ids, "id", "left_semi"))
    id_type = docs.schema["id"].dataType.simpleString()

    def links(table: pa.Table) -> pa.Table:
        get = {name: table.column(name).combine_chunks() for name in table.column_names}
        block = get["block"].to_numpy(zero_copy_only=False)
        p, q = get["p"][0].as_py(), get["q"][0].as_py()
        left = np.flatnonzero(block == p)
        right = left if p == q else np.flatnonzero(block == q)
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in get["elements"]]
        component = get["component"].to_numpy(zero_copy_only=False)
        first, second = _matrix(get["first"]), _matrix(get["second"])
        found = list(block_links(get["i"][0].as_py(), left, right, component, first, second, sets))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({name: get["id"].take(pa.array(x, pa.int64())) for name, x in (("a", a), ("b", b))})

    met = rows.join(sets, "id").groupBy("i", "half", "p", "q")
    return written(met.applyInArrow(links, f"a {id_type}, b {id_type}"), "near-links")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    signed = written(signatures(docs, id_column, text_column), "near-signatures")
    members, classes = _classes(signed)
    forget(signed)
    groups = _groups(members)
    ids = groups.select("id").distinct()
    leads = members.where(F.col("first").isNotNull()).join(ids, "id", "left_semi").select("id", "first", "second")
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # Rows that repeat an id are one document; the join has dealt them out by id already.
    texts = leads.dropDuplicates(["id"]).join(texts, "id").dropDuplicates(["id"])
    texts = written(texts, "near-texts")

    links = _compared(_to_leaders(groups), texts)
    more = _across(groups, components(links), texts)
    joined = components(links.unionByName(more)).withColumnRenamed("id", "rep")
    forget(groups, texts)

    sized = joined.join(classes, "rep", "left").select("rep", "component", F.coalesce("n", F.lit(1)).alias("n"))
    sized = written(sized, "near-components")
    component = F.coalesce("component", "rep")
    return salted_join(members.select("id", "n_shingles", "rep"), sized, ["rep"], "n", "id", "left").select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each component, with all its columns; those with a null id stay."""
    kept = near_duplicates(docs, id_column, text_column).where("kept").select(id_column).distinct()
    return semi_join_ids(docs, kept, id_column)
