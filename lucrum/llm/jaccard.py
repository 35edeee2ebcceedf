"""N-gram Jaccard join: rare-first prefix filtering with length, positional and
suffix filters, joined on prefix n-grams and verified once per pair.

1. Texts of equal n-gram sets form a class; only classes are compared.
2. n-grams are counted over all documents. A set in ascending count order can
   only be similar to one that shares an n-gram of its short rare-first prefix.
3. Classes are joined on (prefix n-gram, length band). The bands make the
   length filter part of the join key. Each key ties its classes to its least
   class, so a key of n classes gives n rows, never n*n pairs; what is tied
   together is a cluster, outside of which no class has a partner.
4. Clusters are cut into chunks of classes. Each pair of chunks meets once, in
   one task, where pairs with a common prefix n-gram pass the length,
   positional and suffix filters and are verified exactly, each once. A chunk
   pair yields the links of its classes as counts and as a spanning forest.
5. Components of the forest are the classes' components.

The result is exact: nothing is capped or sampled. Two documents are similar
when 100 * |intersection| >= percent * |union|.

Null and wordless texts have the empty set, are linked with nothing and are
their own component. Rows with a null id take part in links but give no
component its id (the component of only such rows is null). Repeated rows are
copies like others. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lucrum.llm.common import (PACKED, SEED, count_keys, mix, pack_blocks, pack_keys, parts_for, squeeze, stored,
                               unpack, unsqueeze, word_hashes)
from lucrum.llm.graph import components

CHUNK = 128             # classes of a chunk in clusters of up to CHUNK**2 classes
LARGEST_CHUNK = 4_096   # beyond that chunks grow, up to this
RARE_CAP = 255          # n-grams more frequent than this are ordered by hash
_STEP = [pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) | 1 for i in range(64)]


def shingles(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Each text's distinct n-gram hashes, ascending; of a text with fewer words
    the whole sequence, of one without words nothing."""
    w, at = word_hashes(texts)
    n = len(w) - words + 1
    runs = np.zeros(0, np.uint64)
    if n > 0:
        runs = np.full(n, words, np.uint64) * SEED
        for i in range(words):
            runs += w[i:i + n] * np.uint64(_STEP[i])
        runs = mix(runs)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(runs[a:b - words + 1]))
        elif b > a:
            own = np.array([b - a], np.uint64) * SEED
            for i in range(b - a):
                own += w[a + i:a + i + 1] * np.uint64(_STEP[i])
            out.append(mix(own))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class_of(found: np.ndarray) -> int | None:
    """One number for equal sets; none for the empty set."""
    if not len(found):
        return None
    h = mix(mix(found).sum(keepdims=True) + np.array([len(found)], np.uint64) * SEED)
    return int(h.astype(np.int64)[0])


def prefix_size(n: int, percent: int) -> int:
    """Members of a set of n that any similar set must meet: one more than may
    be missing."""
    return n - -(-percent * n // 100) + 1


def find_links(rows: list[np.ndarray], split: int | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of similar sets among ``rows`` (ascending arrays in one
    common rare-first order), or with ``split`` only those between
    rows[:split] and rows[split:]."""
    size = np.array([len(r) for r in rows])
    head = np.array([prefix_size(int(n), percent) for n in size])
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.concatenate([r[:p] for r, p in zip(rows, head)])
    row = np.repeat(np.arange(len(rows)), head)
    pos = np.arange(len(key)) - np.repeat(np.cumsum(head) - head, head)
    order = np.argsort(key, kind="stable")
    key, row, pos = key[order], row[order], pos[order]
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    xs, ys, xp, yp = [], [], [], []
    for a, b in zip(edge[:-1][np.diff(edge) > 1].tolist(), edge[1:][np.diff(edge) > 1].tolist()):
        if split is None:
            i, j = _triangle(b - a)
        else:
            mid = int(np.searchsorted(row[a:b], split))
            if not 0 < mid < b - a:
                continue
            i, j = np.repeat(np.arange(mid), b - a - mid), np.tile(np.arange(mid, b - a), mid)
        xs.append(row[a + i])
        ys.append(row[a + j])
        xp.append(pos[a + i])
        yp.append(pos[a + j])
    if not xs:
        return none
    x, y, xp, yp = (np.concatenate(v) for v in (xs, ys, xp, yp))
    # length
    keep = 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
    x, y, xp, yp = x[keep], y[keep], xp[keep], yp[keep]
    if not len(x):
        return none
    # positions: what was met up to the last common prefix n-gram, and at most all that follows
    order = np.lexsort((xp, x * len(rows) + y))
    x, y, xp, yp = x[order], y[order], xp[order], yp[order]
    pair = x * len(rows) + y
    last = np.flatnonzero(np.append(pair[1:] != pair[:-1], True))
    met = np.diff(np.concatenate(([-1], last)))
    x, y, xp, yp = x[last], y[last], xp[last], yp[last]
    need = -(-percent * (size[x] + size[y]) // (100 + percent))
    keep = met + np.minimum(size[x] - xp, size[y] - yp) - 1 >= need
    x, y, need = x[keep], y[keep], need[keep]
    if not len(x):
        return none
    # suffix: the order is cut at common points; no more is shared than the smaller side has between two
    used = np.unique(np.concatenate((x, y)))
    whole = np.concatenate([rows[i] for i in used])
    points = np.sort(whole[::max(1, len(whole) // 4096)])
    points = points[len(points) // 16::max(1, len(points) // 16)]
    between = np.zeros((len(rows), len(points) + 1), np.int32)
    for i in used:
        between[i] = np.diff(np.concatenate(([0], np.searchsorted(rows[i], points), [size[i]])))
    keep = np.minimum(between[x], between[y]).sum(1) >= need
    x, y, need = x[keep], y[keep], need[keep]
    # verification, a row of x against all its candidates at a time
    _, code = np.unique(whole, return_inverse=True)
    begin = np.zeros(len(rows) + 1, np.int64)
    begin[used + 1] = size[used]
    begin = np.cumsum(begin)
    mark = np.zeros(int(code.max()) + 1 if len(code) else 1, bool)
    order = np.argsort(x, kind="stable")
    x, y, need = x[order], y[order], need[order]
    good = np.zeros(len(x), bool)
    edge = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1], [True]))) if len(x) else np.zeros(1, int)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        own = code[begin[x[a]]:begin[x[a] + 1]]
        mark[own] = True
        for k in range(a, b):
            good[k] = np.count_nonzero(mark[code[begin[y[k]]:begin[y[k] + 1]]]) >= need[k]
        mark[own] = False
    return x[good], y[good]


_TRIANGLE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _triangle(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _TRIANGLE:
        if len(_TRIANGLE) > 512:
            _TRIANGLE.clear()
        _TRIANGLE[n] = np.triu_indices(n, 1)
    return _TRIANGLE[n]


def _chunk_links(left: list[dict], right: list[dict] | None, percent: int) -> pa.RecordBatch:
    """(a, b, links): spanning forest of the links of a chunk (or between two
    chunks) with links 0, and for each linked class a, with b null, how many
    documents it is linked with there."""
    both = left + (right or [])
    rows = [np.frombuffer(m["keys"], "<u8") for m in both]
    copies = np.array([m["copies"] for m in both])
    links = np.zeros(len(both), np.int64)
    root = list(range(len(both)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    a_out, b_out = [], []
    n = len(left)
    lefts = [(i, min(n, i + CHUNK)) for i in range(0, n, CHUNK)]
    rights = [(i, min(len(both), i + CHUNK)) for i in range(n, len(both), CHUNK)]
    tiles = ([(p, q) for p in lefts for q in rights] if right is not None
             else [(p, q) for k, p in enumerate(lefts) for q in [None, *lefts[k + 1:]]])
    for (a, b), other in tiles:
        at = np.concatenate((np.arange(a, b), np.arange(*other))) if other else np.arange(a, b)
        x, y = find_links([rows[i] for i in at], b - a if other else None, percent)
        x, y = at[x], at[y]
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        for i, j in zip(x.tolist(), y.tolist()):
            if (p := find(i)) != (q := find(j)):
                root[p] = q
                a_out.append(both[i]["class"])
                b_out.append(both[j]["class"])
    linked = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [pa.array([*a_out, *(both[i]["class"] for i in linked)], pa.int64()),
         pa.array([*b_out, *([None] * len(linked))], pa.int64()),
         pa.array([*([0] * len(a_out)), *links[linked].tolist()], pa.int64())], ["a", "b", "links"])


def similar(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row for each row of docs: ``id_col``, n_shingles (size of its set),
    n_links (documents it is linked with, copies included) and component_id
    (smallest id reachable by links, its own included)."""
    if not 0 < percent <= 100 or not 1 <= words <= len(_STEP):
        raise ValueError("percent must be 1 to 100 and words 1 to 64")
    spark = docs.sparkSession

    def derive(texts: list[bytes]) -> tuple[list, list]:
        found = shingles(texts, words)
        return [len(f) for f in found], [_class_of(f) for f in found]

    blocks = pack_blocks(docs, id_col, text_col, derive, ("n", "class"))
    members = (blocks.select("block", F.posexplode(F.arrays_zip("ids", "n", "class")).alias("at", "m"))
               .select("block", "at", F.col("m.ids").alias("id"), F.col("m.n").alias("n"), F.col("m.class").alias("class")))
    # a class has its least (block, place) as the copy that is compared
    classes = stored(spark, members.where("class is not null").groupBy("class").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.min(F.struct("block", "at")).alias("first")), "classes")
    n_parts = parts_for(members.agg(F.sum("n")).first()[0] or 0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, body in zip(*(c.to_pylist() for c in batch.columns)):
                keys, counts = np.unique(np.concatenate(shingles(unpack(body, sizes), words)), return_counts=True)
                if len(keys):
                    yield pack_keys(block, 0, keys, counts, n_parts)

    counted = stored(spark, count_keys(blocks.select("block", "sizes", "body").mapInArrow(pack, PACKED), ((0,),),
                                       cap=RARE_CAP).where("block is not null").select("block", "part", "t0"), "counts")

    def prefixes(block: pa.Table, more: pa.Table) -> pa.Table:
        """Classes of a block with the prefix n-grams that others have too."""
        out = {c: [] for c in ("class", "n", "copies", "head", "keys")}
        more = more.sort_by("part")
        rep = more.filter(pa.compute.equal(more["part"], -1))
        counts = more.filter(pa.compute.greater_equal(more["part"], 0))["t0"].to_pylist()
        if len(rep):
            found = shingles(unpack(block["body"][0].as_py(), block["sizes"][0].as_py()), words)
            keys = np.unique(np.concatenate(found))
            count = np.concatenate([unsqueeze(c) for c in counts]).astype(np.uint64)
            for r in rep["reps"][0].as_py():
                own = found[r["at"]]
                rank = np.sort((count[np.searchsorted(keys, own)] << np.uint64(56)) | (own >> np.uint64(8)))
                head = rank[:prefix_size(len(own), percent)]
                c = head >> np.uint64(56)
                head = head[(c > r["copies"]) | (c == RARE_CAP)]
                if len(head):
                    for name, v in (("class", r["class"]), ("n", len(own)), ("copies", r["copies"]),
                                    ("head", head.astype(np.int64).tolist()), ("keys", rank.tobytes())):
                        out[name].append(v)
        return pa.table({n: pa.array(out[n], t) for n, t in (("class", pa.int64()), ("n", pa.int64()), ("copies", pa.int64()),
                                                             ("head", pa.list_(pa.int64())), ("keys", pa.binary()))})

    reps = (classes.select("first.block", F.struct("first.at", "class", "copies").alias("r"))
            .groupBy("block").agg(F.collect_list("r").alias("reps")))       # bounded by the texts of a block
    rep_type = reps.schema["reps"].dataType.simpleString()
    more = counted.withColumn("reps", F.lit(None).cast(rep_type)).unionByName(
        reps.select("block", F.lit(-1).alias("part"), F.lit(None).cast("binary").alias("t0"), "reps"))
    sets = stored(spark, blocks.select("block", "sizes", "body").groupBy("block").cogroup(more.groupBy("block")).applyInArrow(
        prefixes, "class long, n long, copies long, head array<long>, keys binary"), "sets")

    # join on prefix n-gram and length band: sizes that differ by no more than the threshold allows are in one band or in neighbouring bands
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent * 1.001 + 1e-9)))
    keyed = (sets.select("class", band.alias("band"), F.explode("head").alias("gram"))
             .select("class", "gram", F.explode(F.array("band", F.col("band") + 1)).alias("band")))
    hubs = keyed.groupBy("gram", "band").agg(F.min("class").alias("hub"), F.max("class").alias("far")).where("hub < far")
    ties = keyed.join(hubs, ["gram", "band"]).where("class != hub").select(F.col("class").alias("a"), F.col("hub").alias("b"))
    cluster = components(ties)
    sizes = cluster.groupBy("root").agg(F.count("*").alias("in_cluster"))
    chunk_size = F.greatest(F.lit(CHUNK), F.least(F.lit(LARGEST_CHUNK), F.ceil(F.col("in_cluster") / CHUNK)))
    placed = (cluster.join(sizes, "root").withColumn("n_chunks", F.ceil(F.col("in_cluster") / chunk_size).cast("int"))
              .select(F.col("node").alias("class"), "root", "n_chunks", F.pmod(F.xxhash64("node"), F.col("n_chunks")).cast("int").alias("chunk")))
    chunks = stored(spark, sets.select("class", "copies", "keys").join(placed, "class")
                    .groupBy("root", "chunk", "n_chunks").agg(F.collect_list(F.struct("class", "copies", "keys")).alias("members")), "chunks")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.column(0):
                yield _chunk_links(m.as_py(), None, percent)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                yield _chunk_links(a.as_py(), b.as_py(), percent)

    pairs = (chunks.where("chunk + 1 < n_chunks").select("root", F.col("members").alias("left"),
                                                         F.explode(F.expr("sequence(chunk + 1, n_chunks - 1)")).alias("chunk"))
             .join(chunks.where("n_chunks > 1").select("root", "chunk", "members"), ["root", "chunk"]))
    found = stored(spark, chunks.select("members").mapInArrow(within, "a long, b long, links long").unionAll(
        pairs.select("left", "members").mapInArrow(between, "a long, b long, links long")), "links")

    group = components(found.where("b is not null").select("a", "b"))
    weight = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    named = (classes.select("class", "id", "copies").join(group.withColumnRenamed("node", "class"), "class", "left")
             .withColumn("root", F.coalesce("root", "class")).join(weight, "class", "left"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    final = named.join(least, "root").select("class", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return (members.select("id", "n", "class").join(final, "class", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
