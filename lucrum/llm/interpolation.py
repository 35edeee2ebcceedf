"""Language-model scoring by deleted interpolation.

A word's probability after its predecessor mixes three estimates: the bigram's
and the word's maximum likelihood, and the uniform one over the known words and
one unknown. The weights depend on how often the predecessor was met, in
buckets of a factor of two. They are learned by expectation-maximisation: with
counts from one part of the training texts, on the tokens of the rest, which
were deleted from those counts. The final model uses these weights with the
counts of all training texts.

All counts cover all texts: texts are packed into blocks, each block sends its
distinct words and bigrams once to the parts that count them, and gets their
totals back. What a task holds is a block or a part, both of bounded size; no
model is broadcast or collected but its weights. For learning the weights the
driver gets a histogram of the estimates' ratios, bounded by its bins.

Null texts count as empty: they consist of the end alone. Documents with null
ids are scored like others. Repeated rows count each time. Extra columns are
ignored. Without training texts every token is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lucrum.llm.common import PACKED, count_keys, mix, pack_blocks, pack_keys, parts_for, stored, unpack, unsqueeze, word_hashes

COUNTED, TUNED, HELD = 0, 1, 2      # kinds of texts: counted at first, weights learned on, only scored
END = np.uint64(0x0123456789ABCDEF)  # the end of a text, also what stands before its first word
BUCKETS = 48
BINS = 64                            # of a ratio, half a factor of two each
ROUNDS = 200


def sequence(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of the texts, each text's words and then the end; the bigram
    that each token closes; the number of tokens of each text."""
    w, at = word_hashes(texts)
    tokens = np.insert(w, at[1:], END)
    before = np.concatenate(([END], tokens[:-1])) if len(tokens) else tokens
    return tokens, mix(before * np.uint64(0xC2B2AE3D27D4EB4F) + tokens), np.diff(at) + 1


def buckets(count: np.ndarray) -> np.ndarray:
    """0 for a predecessor never met, else 1 + floor(log2(count))."""
    return np.where(count > 0, np.minimum(np.floor(np.log2(np.maximum(count, 1))) + 1, BUCKETS - 1), 0).astype(np.int64)


def learn_weights(code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights (bigram, word, uniform) of each bucket from the histogram of
    (bucket, bigram bin, word bin); a bucket without tokens keeps the start."""
    weight = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    weight[0] = [0.0, 0.8, 0.2]
    bucket, pair, word = code // (BINS * BINS), code // BINS % BINS, code % BINS
    # bin 0: never met; bin k: estimate / uniform is about 2**((k - 16) / 2)
    ratio = np.stack([np.where(pair > 0, 2.0 ** ((pair - 16) / 2), 0), np.where(word > 0, 2.0 ** ((word - 16) / 2), 0),
                      np.ones(len(code))], 1)
    total = np.bincount(bucket, n, BUCKETS)
    for _ in range(ROUNDS):
        share = weight[bucket] * ratio
        share *= (n / share.sum(1))[:, None]
        new = np.stack([np.bincount(bucket, share[:, i], BUCKETS) for i in range(3)], 1)
        # a thousandth of a token for each estimate keeps every weight above 0
        new = np.where(total[:, None] > 0, (new + 1e-3) / (total + 3e-3)[:, None], weight)
        new[0] = [0, new[0, 1] / (new[0, 1] + new[0, 2]), new[0, 2] / (new[0, 1] + new[0, 2])]
        moved = np.abs(new - weight).max()
        weight = new
        if moved < 1e-7:
            break
    return weight


def _bins(ratio: np.ndarray) -> np.ndarray:
    return np.where(ratio > 0, np.clip(np.round(2 * np.log2(np.maximum(ratio, 1e-300))) + 16, 1, BINS - 1), 0).astype(np.int64)


def _estimates(body: bytes, sizes: list[int], counts: list[bytes], n_total: int, n_words: int):
    """For each token of a block: bigram and word estimate, the predecessor's
    count, the token's count; the number of tokens of each text."""
    tokens, pairs, lengths = sequence(unpack(body, sizes))
    word_keys, word_at = np.unique(tokens, return_inverse=True)
    pair_keys, pair_at = np.unique(pairs, return_inverse=True)
    flat = np.concatenate([unsqueeze(c) for c in counts])
    c = flat[:len(word_keys)][word_at]
    c_pair = flat[len(word_keys):][pair_at]
    first = flat[np.searchsorted(word_keys, END)]
    c_before = np.concatenate(([first], c[:-1]))
    return (np.where(c_before > 0, c_pair / np.maximum(c_before, 1), 0.0), c / max(n_total, 1), c_before, c, lengths)


def score(docs: DataFrame, kind: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: ``id_col``, kind, n_tokens, n_known (tokens
    that occur in training texts), train_tokens, base_score (log10 probability
    under the add-one-half unigram estimate), score (under the model).

    ``kind``: 0 or 1 for training texts, 1 for those that the weights are
    learned on, 2 for texts that are only scored."""
    blocks = pack_blocks(docs, id_col, text_col, lambda texts: ([len(t.split()) + 1 for t in texts],), ("n",), kind)
    n_tokens = blocks.select(F.explode("n").alias("n")).agg(F.sum("n")).first()[0] or 0
    word_parts, pair_parts = parts_for(n_tokens // 4), parts_for(n_tokens)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, k, sizes, body in zip(*(c.to_pylist() for c in batch.columns)):
                tokens, pairs, _ = sequence(unpack(body, sizes))
                yield pack_keys(block, k, *np.unique(tokens, return_counts=True), word_parts, exact=True)
                yield pack_keys(block, k, *np.unique(pairs, return_counts=True), pair_parts, first=word_parts, exact=True)

    counted = stored(docs.sparkSession, count_keys(
        blocks.select("block", "kind", "sizes", "body").mapInArrow(pack, PACKED),
        ((COUNTED,), (COUNTED, TUNED)), exact_parts=word_parts + pair_parts), "counts")
    words = counted.where(F.col("block").isNull() & (F.col("part") < word_parts)).agg(
        *(F.coalesce(F.sum(c), F.lit(0)) for c in ("s0", "d0", "s1", "d1"))).first()
    counted = counted.where("block is not null")

    def joined(rows: DataFrame, totals: str, fn, ddl: str) -> DataFrame:
        """fn applied to each block with its totals."""
        def run(block: pa.Table, own: pa.Table) -> pa.Table:
            return fn(block, own.sort_by("part")["t"].to_pylist())
        return (rows.groupBy("block").cogroup(counted.select("block", "kind", "part", F.col(totals).alias("t"))
                                              .where(F.lit(True) if totals == "t1" else F.col("kind") == TUNED)
                                              .select("block", "part", "t").groupBy("block")).applyInArrow(run, ddl))

    n0, v0, n1, v1 = (int(x) for x in words)

    def histogram(block: pa.Table, counts: list[bytes]) -> pa.Table:
        pair, word, before, _, _ = _estimates(block["body"][0].as_py(), block["sizes"][0].as_py(), counts, n0, v0)
        code, n = np.unique((buckets(before) * BINS + _bins(pair * (v0 + 1))) * BINS + _bins(word * (v0 + 1)), return_counts=True)
        return pa.table({"code": pa.array(code, pa.int64()), "n": pa.array(n, pa.int64())})

    tuned = joined(blocks.where(F.col("kind") == TUNED).select("block", "sizes", "body"), "t0", histogram, "code long, n long")
    cells = tuned.groupBy("code").agg(F.sum("n").alias("n")).collect()
    weight = learn_weights(np.array([r.code for r in cells], np.int64), np.array([r.n for r in cells], float))

    def final(block: pa.Table, counts: list[bytes]) -> pa.Table:
        pair, word, before, c, lengths = _estimates(block["body"][0].as_py(), block["sizes"][0].as_py(), counts, n1, v1)
        w = weight[buckets(before)]
        p = w[:, 0] * pair + w[:, 1] * word + w[:, 2] / (v1 + 1)
        base = (c + 0.5) / (n1 + 0.5 * (v1 + 1))
        begin = np.cumsum(lengths) - lengths
        add = lambda x: np.add.reduceat(x, begin)
        return pa.table({"id": block["ids"][0].values, "kind": pa.array(np.full(len(lengths), block["kind"][0].as_py()), pa.int32()),
                         "n_tokens": pa.array(lengths, pa.int64()), "n_known": pa.array(add((c > 0).astype(np.int64)), pa.int64()),
                         "train_tokens": pa.array(np.full(len(lengths), n1), pa.int64()),
                         "base_score": add(np.log10(base)), "score": add(np.log10(p))})

    return joined(blocks.select("block", "kind", "ids", "sizes", "body"), "t1", final,
                  "id long, kind int, n_tokens long, n_known long, train_tokens long, base_score double, score double"
                  ).withColumnRenamed("id", id_col)
