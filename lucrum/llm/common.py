"""Helpers shared by the operators: hashing of word runs, packing of texts
into blocks, and counts of keys over all blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lucrum.config import scratch_path

BLOCK_BYTES = 3_000_000       # text bytes in a block; a longer text is a block of its own
PART_KEYS = 1_000_000         # keys that one counting group holds, about
SEED = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D    # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[int, np.ndarray] = {}

#: white space of the word pattern [^\x20\x09-\x0D]+
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept in the worker."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if n <= 1 << 22:
            _POW[base] = have
    return have[:n]


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every buf[start:end]; equal bytes give equal hashes
    wherever they stand. One pass over the buffer, none per span."""
    n = len(buf)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
    own = (total[end] - total[start]) * powers(_BASE_INV, n + 1)[start]
    return mix(own + (end - start).astype(np.uint64) * SEED)


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space."""
    solid = ~_SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).view(np.int8)))
    return edge[0::2], edge[1::2]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and the number of words
    before each text (one more entry than texts). A-Z count as a-z."""
    joined = b"\n".join(texts).lower()
    buf = np.frombuffer(joined, np.uint8)
    start, end = word_spans(buf)
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    return span_hashes(buf, start, end), np.searchsorted(start, at)


def pack_blocks(docs: DataFrame, id_col: str, text_col: str, derive=None, derived: tuple[str, ...] = (),
                kind: Column | None = None) -> DataFrame:
    """Texts packed into blocks of about ``BLOCK_BYTES``, written to the shared
    scratch folder and read back, so that block numbers stay as they are when
    tasks run again.

    Columns: block (long), kind (int, of all its texts; 0 without ``kind``),
    ids (list of long), sizes (bytes of each text, list of int), body
    (compressed concatenation), and for each name in ``derived`` a list of long
    that ``derive(texts)`` returns. A null text is packed as empty."""
    spark = docs.sparkSession
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                      (F.lit(0) if kind is None else kind).cast("int").alias("kind"))
    schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("ids", pa.list_(pa.int64())),
                        ("sizes", pa.list_(pa.int32())), ("body", pa.binary()),
                        *((n, pa.list_(pa.int64())) for n in derived)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        press = zstandard.ZstdCompressor(level=1)
        held: dict[int, list] = {}      # by kind: ids, texts, bytes

        def flush(k: int) -> pa.RecordBatch:
            nonlocal number
            ids, texts, _ = held.pop(k)
            more = derive(texts) if derive else ()
            number += 1
            row = [[number - 1], [k], [ids], [[len(t) for t in texts]], [press.compress(b"".join(texts))],
                   *([m] for m in more)]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for key, text, k in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                body = text.as_py().encode()
                if k in held and held[k][2] + len(body) > BLOCK_BYTES:
                    yield flush(k)
                own = held.setdefault(k, [[], [], 0])
                own[0].append(key)
                own[1].append(body)
                own[2] += len(body)
        for k in list(held):
            yield flush(k)

    ddl = "block long, kind int, ids array<long>, sizes array<int>, body binary" + "".join(
        f", {n} array<long>" for n in derived)
    return stored(spark, src.mapInArrow(run, ddl), "blocks", compression="none")


def unpack(body: bytes, sizes: list[int]) -> list[bytes]:
    """The texts of a block."""
    whole = zstandard.ZstdDecompressor().decompress(body)
    ends = np.cumsum([0, *sizes])
    return [whole[a:b] for a, b in zip(ends[:-1], ends[1:])]


def stored(spark: SparkSession, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df written to the shared scratch folder and read back: cuts the lineage
    with files that outlive any executor."""
    path = scratch_path(spark, f"llm/{name}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(n_keys: int) -> int:
    """Counting groups for that many keys; grows with the input."""
    return max(8, -(-n_keys // PART_KEYS))


def pack_keys(block: int, kind: int, keys: np.ndarray, counts: np.ndarray, n_parts: int, first: int = 0,
              exact: bool = False) -> pa.RecordBatch:
    """A block's distinct keys (64-bit hashes, ascending) and their counts, cut
    into the parts ``first`` and on that count them. A part is a range of the
    hash's upper half; the lower half names a key within its part, so about one
    key in two thousand shares its count with another, at any input size. With
    ``exact`` the whole hash names it."""
    part = ((keys >> np.uint64(32)) * np.uint64(n_parts)) >> np.uint64(32)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(keys)])) if len(keys) else np.zeros(1, int)
    cut = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
    names = keys.astype("<u8" if exact else "<u4")     # <u4 keeps the lower half
    counts = counts.astype("<u4")
    return pa.RecordBatch.from_arrays(
        [pa.array(part[edges[:-1]].astype(np.int32) + np.int32(first)), pa.array([block] * len(cut), pa.int64()),
         pa.array([kind] * len(cut), pa.int32()),
         pa.array([names[a:b].tobytes() for a, b in cut], pa.binary()),
         pa.array([squeeze(counts[a:b]) for a, b in cut], pa.binary())], ["part", "block", "kind", "names", "counts"])


PACKED = "part int, block long, kind int, names binary, counts binary"


def squeeze(values: np.ndarray) -> bytes:
    """Compressed unsigned integers in the narrowest fitting width."""
    top = int(values.max()) if len(values) else 0
    code = "<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8"
    return code[-1:].encode() + zstandard.ZstdCompressor(level=1).compress(values.astype(code).tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), "<u" + data[:1].decode()).astype(np.int64)


def count_keys(packed: DataFrame, kinds: tuple[tuple[int, ...], ...], exact_parts: int = 0,
               cap: int | None = None) -> DataFrame:
    """For every packed row (block, kind, part) the totals of its keys over all
    blocks, in the row's order: one column t0, t1, ... for each group of block
    kinds in ``kinds``, cut off at ``cap``. The parts below ``exact_parts`` were packed with ``exact``. A further row with a null block
    holds, for each part, how many keys have a total above 0 (d0, d1, ...) and the
    sum of totals (s0, s1, ...).

    A key reaches its part once from each block that has it, already summed
    there, so a frequent key is no larger than the number of blocks."""
    n = len(kinds)
    schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), *((f"t{i}", pa.binary()) for i in range(n)),
                        *((f"{c}{i}", pa.int64()) for i in range(n) for c in "ds")])

    def total(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        names = [np.frombuffer(x.as_py(), "<u8" if part < exact_parts else "<u4") for x in rows["names"]]
        sizes = [len(x) for x in names]
        kind = np.repeat(rows["kind"].to_numpy(), sizes)
        counts = np.concatenate([unsqueeze(x.as_py()) for x in rows["counts"]])
        found, at = np.unique(np.concatenate(names), return_inverse=True)
        ends = np.cumsum(sizes)
        out = {"block": [*rows["block"].to_pylist(), None], "kind": [*rows["kind"].to_pylist(), None], "part": [part] * (len(sizes) + 1)}
        for i, group in enumerate(kinds):
            sums = np.bincount(at, np.where(np.isin(kind, group), counts, 0), len(found)).astype(np.int64)
            out[f"d{i}"] = [None] * len(sizes) + [int((sums > 0).sum())]
            out[f"s{i}"] = [None] * len(sizes) + [int(sums.sum())]
            own = (sums if cap is None else np.minimum(sums, cap))[at]
            out[f"t{i}"] = [squeeze(own[e - s:e]) for s, e in zip(sizes, ends)] + [None]
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in schema})

    ddl = "block long, kind int, part int" + "".join(f", t{i} binary" for i in range(n)) + "".join(
        f", {c}{i} long" for i in range(n) for c in "ds")
    return packed.groupBy("part").applyInArrow(total, ddl)


def widened(df: DataFrame, **kinds: str) -> T.StructType:
    """df's schema with further columns, name=type."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, T._parse_datatype_string(k)) for n, k in kinds.items())])
