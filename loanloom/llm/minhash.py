"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct 5-word shingles, as 64-bit hashes. The
first bits of a hash choose one of ``REGISTERS`` buckets; of the smallest rest in
a bucket, the register keeps the number of leading zeros and ``MANTISSA`` bits
after them, 16 bits in all. An empty bucket borrows the register of the first
filled one in an order of its own, so that small sets can be compared too. Four
registers are one band, a 64-bit key: documents with 75 % of their shingles in
common share one of the 32 bands but for about 5 in a million pairs.

- Documents with equal sets are one class, named by its smallest id; only
  classes go on.
- Each class is compared with the leader of the band that it shares most with.
  Classes that share a band and are still in different components form a group;
  members of a group are compared block by block, each pair of blocks in one task,
  except members of its largest component with each other. A comparison first
  estimates the similarity from the registers, corrected for registers that agree
  by chance, and leaves out pairs that lie five standard deviations below the
  threshold; the full sets confirm the rest. A task passes on as many links as
  connect its members, not all pairs.
- Confirmed links give connected components. Nothing but counts reaches the
  driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.components import components
from loanloom.llm.scratch import Scratch

SHINGLE = 5
PERCENT = 75
REGISTERS = 128
MANTISSA = 10
ROWS = 4
BANDS = REGISTERS // ROWS
#: Members of a block; two blocks are compared in one task.
BLOCK = 512
#: Columns of the 0/1 matrix by which a task counts common shingles.
COLUMNS = 4096

_BUCKET_BITS = REGISTERS.bit_length() - 1
_TABLE = arrays.byte_table(1, fold_case=True)
_K = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(1, SHINGLE + 1)]
#: The order in which an empty bucket looks for a filled one.
_LENDERS = np.stack([np.random.RandomState(k).permutation(REGISTERS) for k in range(REGISTERS)])


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block."""
    start, end, row = arrays.words(data, offsets, arrays.PLAIN_WORD)
    h = arrays.PrefixHash(data, _TABLE).ranges(start, end)
    n = len(offsets) - 1
    at = arrays.spans(row, n)
    whole = np.zeros(max(len(h) - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        whole += h[k : len(h) - SHINGLE + 1 + k] * _K[k] if len(whole) else whole
    whole = arrays.mix(whole)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(whole[a : b - SHINGLE + 1]))
        elif b > a:
            short = np.uint64(b - a)
            out.append(arrays.mix((h[a:b] * np.array(_K[: b - a])).sum(keepdims=True) + short))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Sets x registers; each set is sorted and not empty."""
    n = len(sets)
    out, filled = np.zeros((n, REGISTERS), np.uint16), np.zeros((n, REGISTERS), bool)
    if not n:
        return out
    hashes = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    bucket = (hashes >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64) + row * REGISTERS
    first = np.ones(len(hashes), bool)  # sorted, so the first of a bucket is its smallest
    first[1:] = bucket[1:] != bucket[:-1]
    rest = hashes[first] << np.uint64(_BUCKET_BITS)
    # frexp is exact on 53 bits; the low 11 of 64 only matter after 52 zeros
    zeros = np.minimum(53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1], 53).astype(np.uint64)
    mantissa = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out.reshape(-1)[bucket[first]] = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    filled.reshape(-1)[bucket[first]] = True
    own = out.copy()
    open_row, open_bucket = np.nonzero(~filled)
    for step in range(REGISTERS):
        if not len(open_row):
            break
        lender = _LENDERS[open_bucket, step]
        found = filled[open_row, lender]
        out[open_row[found], open_bucket[found]] = own[open_row[found], lender[found]]
        open_row, open_bucket = open_row[~found], open_bucket[~found]
    return out


@lru_cache(maxsize=4096)
def _chance(n: int, m: int) -> float:
    """Probability that registers of disjoint sets of 2^n and 2^m elements agree."""
    zeros = np.arange(40)[:, None]
    cell = np.arange(1 << MANTISSA)[None, :]
    low = 2.0 ** -(zeros + 1) * (1 + cell / (1 << MANTISSA))
    high = low + 2.0 ** -(zeros + 1) / (1 << MANTISSA)
    p = [(1 - low) ** k - (1 - high) ** k for k in (max(1.0, 2.0**x / REGISTERS) for x in (n, m))]
    return float((p[0] * p[1]).sum())


def chance(n: int, m: int) -> float:
    return _chance(*sorted((int(n).bit_length(), int(m).bit_length())))


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity of paired registers, corrected for agreement by chance."""
    agree = (a == b).mean(-1)
    pairs, back = np.unique(
        np.stack([np.frexp(n_a)[1], np.frexp(n_b)[1]], -1).reshape(-1, 2), axis=0, return_inverse=True
    )
    by_size = np.array([_chance(*sorted(map(int, p))) for p in pairs])
    c = by_size[back.reshape(-1)].reshape(agree.shape)
    return (agree - c) / (1 - c)


def least_estimate(n_a: np.ndarray, n_b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Five standard deviations below the threshold. What small sets fill of
    the registers is all that an estimate of them rests on."""
    p = percent / 100
    filled = REGISTERS * -np.expm1(-np.maximum(np.minimum(n_a, n_b), 1) / REGISTERS)
    return p - 5 * np.sqrt(p * (1 - p) / filled)


def may_be_similar(
    a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int = PERCENT
) -> np.ndarray:
    """Neither the sizes nor the estimate rule a pair out."""
    sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return sizes & (estimates(a, b, n_a, n_b) >= least_estimate(n_a, n_b, percent))


def set_key(shingles: bytes) -> bytes:
    return hashlib.blake2b(shingles, digest_size=16).digest()


def signatures(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id, n_shingles, set_key (null without words), signature."""
    rows = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in arrays.blocks(batch.column(1)):
                sets = shingle_sets(data, offsets)
                full = [i for i, s in enumerate(sets) if len(s)]
                found = registers([sets[i] for i in full])
                keys: list[bytes | None] = [None] * len(sets)
                signs: list[bytes | None] = [None] * len(sets)
                for k, i in enumerate(full):
                    keys[i] = set_key(sets[i].tobytes())
                    signs[i] = found[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(signs, pa.binary()),
                    ],
                    ["id", "n_shingles", "set_key", "signature"],
                )

    schema = "id long, n_shingles long, set_key binary, signature binary"
    return rows.mapInArrow(arrays.released(run), schema)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """Documents x bands: the four registers of a band, and which band it is."""
    return arrays.mix(signatures.view(np.uint64) ^ arrays.mix(np.arange(1, BANDS + 1, dtype=np.uint64)))


def _bands(classes: DataFrame) -> DataFrame:
    """(rep, band_no, band) of each class, 32 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, _ = arrays.string_buffers(batch.column(1))
            keys = band_keys(data.reshape(batch.num_rows, 2 * REGISTERS))
            rep = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
            number = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
            columns = [pa.array(rep), pa.array(number), pa.array(keys.ravel().view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "band_no", "band"])

    return classes.select("rep", "signature").mapInArrow(
        arrays.released(run), "rep long, band_no int, band long"
    )


def _sets(rows: DataFrame) -> DataFrame:
    """id, shingles (64-bit hashes) of those rows (id, text, set_key) whose set
    is the one that set_key names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in arrays.blocks(batch.column(1)):
                sets = [s.tobytes() for s in shingle_sets(data, offsets)]
                named = batch.column(2).slice(first, last - first).to_pylist()
                same = [set_key(s) == k for s, k in zip(sets, named, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(sets, pa.binary())],
                    ["id", "shingles"],
                ).filter(pa.array(same, pa.bool_()))

    return rows.mapInArrow(arrays.released(run), "id long, shingles binary")


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimate does not rule them out and whose full
    sets are similar enough."""
    signed = classes.select("rep", "n_shingles", "signature")
    for side in ("a", "b"):
        names = {"rep": side, "n_shingles": f"n{side}", "signature": f"s{side}"}
        pairs = pairs.join(signed.withColumnsRenamed(names), side)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                arrays.string_buffers(batch.column(c))[0].view(np.uint16).reshape(-1, REGISTERS)
                for c in (3, 5)
            )
            keep = may_be_similar(x, y, batch.column(2).to_numpy(), batch.column(4).to_numpy(), percent)
            yield batch.select([0, 1]).filter(pa.array(keep))

    pairs = pairs.select("a", "b", "na", "sa", "nb", "sb")
    pairs = pairs.mapInArrow(arrays.released(likely), "a long, b long").distinct()
    joined = pairs.join(sets.withColumnsRenamed({"id": "a", "shingles": "sa"}), "a").join(
        sets.withColumnsRenamed({"id": "b", "shingles": "sb"}), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = joined.select("a", "b", "sa", "sb")
    return joined.mapInArrow(arrays.released(run), "a long, b long").distinct()


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of some sets has in common with each of others:
    a product of 0/1 matrices, some columns at a time."""
    names = np.concatenate([*left, *right])
    _, column, held = np.unique(names, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    shared = held[column] > 1
    column, row = column[shared], row[shared]
    kept, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(kept), COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        part = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out.astype(np.int64)


def _block_links(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components that meet in blocks (i, j) of a group;
    as many as connect the members. ``side`` 0 and 1 are the two blocks, 2 a
    block that meets itself."""

    def run(table: pa.Table) -> pa.Table:
        ids, comp = table["rep"].to_numpy(), table["component"].to_numpy()
        side, size = table["side"].to_numpy(), table["n_shingles"].to_numpy()
        signs = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
        sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        likely = np.zeros((len(left), len(right)), bool)
        for k, x in enumerate(left.tolist()):
            y = np.flatnonzero((comp[right] != comp[x]) & ((side[right] == 1) | (ids[right] > ids[x])))
            if len(y):
                n = np.broadcast_to(size[x], len(y))
                r = right[y]
                likely[k, y] = may_be_similar(signs[r], signs[x][None], size[r], n, percent)
        out_a: list[int] = []
        out_b: list[int] = []
        rows, columns = np.flatnonzero(likely.any(1)), np.flatnonzero(likely.any(0))
        if len(rows):
            x, y = left[rows], right[columns]
            common = common_counts([sets[k] for k in x], [sets[k] for k in y])
            every = size[x][:, None] + size[y][None, :] - common
            linked = likely[np.ix_(rows, columns)] & (100 * common >= percent * every)
            parent = {c: c for c in np.unique(comp).tolist()}

            def root(c: int) -> int:
                while parent[c] != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            for k, m in np.argwhere(linked).tolist():
                p, q = root(int(comp[x[k]])), root(int(comp[y[m]]))
                if p != q:
                    parent[p] = q
                    out_a.append(int(ids[x[k]]))
                    out_b.append(int(ids[y[m]]))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return members.groupBy("grp", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Texts with 100 * common >= ``percent`` * all shingles are linked. A null or
    empty text has no shingles and no links. Repeated rows have one result each,
    the same one; rows with equal ids but other texts have the result of their
    text. A null id links with nothing: its component is null and it is kept.
    Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    signed = scratch.store(signatures(docs, id_column, text_column), "signatures")
    classes = (
        signed.where("set_key IS NOT NULL AND id IS NOT NULL")
        .groupBy("set_key")
        .agg(
            F.min("id").alias("rep"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
    )
    classes = scratch.store(classes, "classes")

    bands = scratch.store(_bands(classes), "bands")
    leaders = bands.groupBy("band").agg(F.min("rep").alias("leader"), F.count("*").alias("n"))
    leaders = scratch.store(leaders.where("n > 1").drop("n"), "leaders")
    members = scratch.store(bands.join(leaders, "band"), "members")
    scratch.drop("bands")
    wanted = classes.select("rep", "set_key").join(members.select("rep").distinct(), "rep", "left_semi")
    wanted = wanted.withColumnRenamed("rep", "id")
    texts = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text"))
    # always a shuffle of the texts: the same plan at every size
    sets = _sets(texts.join(wanted.hint("merge"), "id").select("id", "text", "set_key"))
    sets = scratch.store(sets, "sets")

    # each class with the leader that it shares most bands with
    shared = members.where("rep != leader").groupBy("leader", "rep").agg(F.count("*").alias("n"))
    best = shared.groupBy("rep").agg(F.max(F.struct("n", (-F.col("leader")).alias("l"))).alias("x"))
    stars = best.select((-F.col("x.l")).alias("a"), F.col("rep").alias("b"))
    links = scratch.store(_confirmed(stars, classes, sets, percent), "links")
    joined = scratch.store(components(links, scratch, "first"), "joined")

    # bands with several components: their members form groups, in which all
    # pairs of different components meet, block by block. The largest component
    # of a group meets the others but not itself.
    named = members.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "leader", "rep", F.coalesce("component", "rep").alias("component")
    )
    named = scratch.store(named, "named")
    low, high = F.min("component"), F.max("component")
    mixed = named.groupBy("band").agg(low.alias("low"), high.alias("high")).where("low < high")
    meeting = scratch.store(
        named.join(mixed.select("band"), "band", "left_semi").select("leader", "rep", "component"), "meeting"
    )
    grouped = components(meeting.select(F.col("leader").alias("a"), F.col("rep").alias("b")), scratch, "groups")
    grouped = grouped.select(F.col("node").alias("rep"), F.col("component").alias("grp"))
    rows = meeting.select("rep", "component").distinct().join(grouped, "rep")
    rows = scratch.store(rows, "rows")
    counts = rows.groupBy("grp", "component").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("grp").agg(F.max(F.struct("n", "component")).alias("x"), F.sum("n").alias("n"))
    blocks_of = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    sizes = sizes.select(
        "grp",
        F.col("x.component").alias("main"),
        blocks_of(F.col("x.n")).alias("n_main"),
        blocks_of(F.col("n") - F.col("x.n")).alias("n_other"),
    )
    sizes = sizes.where("n_other > 0")
    salt = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    is_main = F.col("component") == F.col("main")
    # i: a block of others; j: one of others, or n_other + a block of the main component
    own = F.when(is_main, F.col("n_other") + salt(F.col("n_main"))).otherwise(salt(F.col("n_other")))
    others = F.sequence(F.lit(0), F.col("n_other") - 1)
    everything = F.sequence(F.lit(0), F.col("n_other") + F.col("n_main") - 1)
    meets = F.when(
        is_main, F.transform(others, lambda k: F.struct(k.alias("i"), F.col("own").alias("j")))
    ).otherwise(
        F.transform(
            everything,
            lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")),
        )
    )
    rows = rows.join(sizes, "grp").withColumn("own", own)
    signs = classes.select("rep", "n_shingles", "signature")
    rows = rows.join(signs, "rep").join(sets.withColumnRenamed("id", "rep"), "rep")
    rows = rows.withColumn("m", F.explode(meets)).select(
        "grp",
        "rep",
        "component",
        "n_shingles",
        "signature",
        "shingles",
        F.col("m.i").alias("i"),
        F.col("m.j").alias("j"),
        F.when(F.col("m.i") == F.col("m.j"), 2).when(F.col("own") == F.col("m.j"), 1).otherwise(0).alias("side"),
    )
    more = scratch.store(_block_links(rows, percent), "more-links")
    if more.isEmpty():
        final = joined
    else:
        both = links.select("a", "b").unionAll(more)
        final = scratch.store(components(both, scratch, "second"), "components")
    of_class = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left")
    of_class = of_class.select("set_key", F.coalesce("component", "rep").alias("component_id"))
    of_class = scratch.store(of_class, "class-components")
    scratch.drop("leaders", "members", "sets", "named", "meeting", "rows", "classes")

    named_rows = signed.select("id", "n_shingles", "set_key")
    alone = (F.col("set_key").isNull()) | F.col("id").isNull()
    single = named_rows.where(alone).select("id", "n_shingles", F.col("id").alias("component_id"))
    linked = named_rows.where(~alone).join(of_class, "set_key", "left")
    result = single.unionAll(linked.select("id", "n_shingles", "component_id"))
    return result.select(
        F.col("id").alias(id_column),
        "n_shingles",
        "component_id",
        (F.col("id").isNull() | (F.col("component_id") == F.col("id"))).alias("kept"),
    )
