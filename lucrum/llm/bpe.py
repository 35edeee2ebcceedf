"""Byte-level BPE encoding and decoding: speculate and verify.

A pre-token is first cut greedily into the longest vocabulary entries. The cut
is the BPE result exactly when each entry alone and each two neighbours, merged
from single bytes, come out unchanged. Those tests depend only on the pair, so
they are done for all neighbours of a batch at once against a sorted table of
pairs that are known, and a pair is worked out the first time it is met. Only
pre-tokens with a failing pair are merged step by step.

Texts are cut into pieces before each white space that follows a solid
character, which never divides a pre-token; ids of pieces are kept
during a task in a table of bounded size, so a frequent piece is encoded once.

Null texts count as empty and give no ids. Null ids, repeated rows and extra
columns pass through unchanged. Texts of any length are encoded whole.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lucrum.llm.common import widened

MAX_FILE_BYTES = 64_000_000    # a vocabulary file is sent to every worker
KEPT_PIECES = 300_000          # pieces whose ids a worker keeps
GROUP_CHARS = 1_000_000        # characters that are encoded together
OUT_ROWS = 256

#: White space of the pre-token pattern, the pattern itself.
WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WS + r"\p{L}\p{N}]+"
            r"|[" + WS + r"]+(?![^" + WS + r"])|[" + WS + r"]+")

_MODELS: dict[str, "Bpe"] = {}


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Vocabulary tables and the two directions, for use inside a task."""

    def __init__(self, source: str):
        spec = json.loads(source)
        letters = _byte_letters()
        as_bytes = lambda t: bytes(letters[c] for c in t)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.id_of = {as_bytes(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.bytes_of = {i: b for b, i in self.id_of.items()} | {i: t.encode() for t, i in self.special.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (as_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merge[self.id_of[a], self.id_of[b]] = (rank, self.id_of[a + b])
        self.rank = {pair: rank for pair, (rank, _) in self.merge.items()}
        self.made = [new for _, new in self.merge.values()]
        self.byte_id = [self.id_of[bytes((i,))] for i in range(256)]
        self.longest: dict[bytes, int] = {}
        for b in self.id_of:
            for k in (2, 4):
                if len(b) >= k:
                    self.longest[b[:k]] = max(self.longest.get(b[:k], 1), len(b))
        self.pretoken = regex.compile(PRETOKEN)
        self.coarse = re.compile(f"[{WS}]*[^{WS}]+|[{WS}]+")
        self.cut_special = re.compile("(" + "|".join(re.escape(t) for t in self.special) + ")") if self.special else None
        self.good = np.zeros(0, np.int64)      # neighbours that stay as they are
        self.bad = np.zeros(0, np.int64)
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.packers = [struct.Struct(f"<{n}I").pack for n in range(32)]

    # -- one pre-token ---------------------------------------------------
    def exact(self, word: bytes) -> list[int]:
        """Merges the pair of lowest rank, the leftmost first, until none is left."""
        ids = list(map(self.byte_id.__getitem__, word))
        if len(ids) <= 64:
            rank, none = self.rank, len(self.made)
            ranks = [rank.get(pair, none) for pair in zip(ids, ids[1:])]
            while ranks and (low := min(ranks)) < none:
                i = ranks.index(low)
                ids[i:i + 2] = [self.made[low]]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank.get((ids[i - 1], ids[i]), none)
                if i < len(ranks):
                    ranks[i] = rank.get((ids[i], ids[i + 1]), none)
            return ids
        merge = self.merge
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        alive, n = [True] * len(ids), len(ids)
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = new, False, after[j]
            if after[j] < n:
                before[after[j]] = i
                if m := merge.get((new, ids[after[j]])):
                    heapq.heappush(heap, (m[0], i, new, ids[after[j]], m[1]))
            if before[i] >= 0 and (m := merge.get((ids[before[i]], new))):
                heapq.heappush(heap, (m[0], before[i], ids[before[i]], new, m[1]))
        return [t for t, live in zip(ids, alive) if live]

    def greedy(self, word: bytes) -> list[int]:
        """Longest entry first, from the left."""
        out, at, n, id_of, longest = [], 0, len(word), self.id_of, self.longest
        while at < n:
            stop = min(n, at + (longest.get(word[at:at + 4]) or min(3, longest.get(word[at:at + 2], 1))))
            while stop > at + 1 and word[at:stop] not in id_of:
                stop -= 1
            out.append(id_of[word[at:stop]])
            at = stop
        return out

    # -- many pre-tokens -------------------------------------------------
    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token: greedy cut, one test of all neighbours, exact
        merging of the pre-tokens that fail. An entry on its own is the pair
        (entry, none)."""
        cuts = [self.greedy(w) for w in words]
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        flat = np.fromiter((t for c in cuts for t in c), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(cuts)), sizes)
        right = np.append(flat[1:], 0)
        last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
        lone = last & (sizes[owner] == 1) if len(owner) else last
        code = (flat << 20) | np.where(lone, (1 << 20) - 1, right)
        use = ~last | lone
        code, owner = code[use], owner[use]
        for pair in np.setdiff1d(np.unique(code), np.concatenate((self.good, self.bad)), assume_unique=True).tolist():
            a, b = pair >> 20, pair & ((1 << 20) - 1)
            want = [a] if b == (1 << 20) - 1 else [a, b]
            same = self.exact(b"".join(self.bytes_of[t] for t in want)) == want
            self._new_good.append(pair) if same else self._new_bad.append(pair)
        if self._new_good or self._new_bad:
            self.good = np.union1d(self.good, np.array(self._new_good, np.int64))
            self.bad = np.union1d(self.bad, np.array(self._new_bad, np.int64))
            self._new_good.clear()
            self._new_bad.clear()
        for i in np.unique(owner[np.isin(code, self.bad)]).tolist():
            cuts[i] = self.exact(words[i])
        return cuts

    _new_good: list[int] = []
    _new_bad: list[int] = []

    def cut(self, text: str) -> list[str]:
        """Pieces whose pre-tokens don't depend on their neighbours."""
        if "  " in text:
            return self.coarse.findall(text)
        head, *rest = text.split(" ")
        return ([head] if head else []) + [" " + p for p in rest]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts: list[list] = []
        mixed = set()
        for i, text in enumerate(texts):
            if self.cut_special and any(t in text for t in self.special):
                mixed.add(i)
                own = []
                for j, seg in enumerate(self.cut_special.split(text)):
                    own += [self.special[seg]] if j % 2 else self.cut(seg)
                parts.append(own)
            else:
                parts.append(self.cut(text))
        have = self.pieces
        wanted = {p for own in parts for p in own}.difference(self.special.values())
        new = wanted.difference(have)
        if new:
            if len(have) + len(new) > KEPT_PIECES:
                have.clear()
                new = wanted
            order, known = list(new), self.words
            words = [self.pretoken.findall(p) for p in order]
            unseen = list({w for ws in words for w in ws if w not in known})
            if len(known) + len(unseen) > KEPT_PIECES:
                known.clear()
                unseen = list({w for ws in words for w in ws})
            for w, ids in zip(unseen, self.encode_words([w.encode() for w in unseen])):
                known[w] = self.packers[len(ids)](*ids) if len(ids) < 32 else np.array(ids, "<u4").tobytes()
            for p, ws in zip(order, words):
                have[p] = known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])
        return [b"".join([p.to_bytes(4, "little") if isinstance(p, int) else have[p] for p in own]) if i in mixed
                else b"".join(map(have.__getitem__, own)) for i, own in enumerate(parts)]

    def forget(self) -> None:
        """Gives the kept pieces' memory back: a worker outlives its task."""
        self.pieces.clear()
        self.words.clear()

    def decode(self, ids: bytes) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _model(source) -> Bpe:
    """The worker's tables for a broadcast vocabulary."""
    text = source.value
    key = f"{len(text)}-{hash(text)}"
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Bpe(text)
    return _MODELS[key]


def _source(df: DataFrame, vocab_path: str):
    if os.path.getsize(vocab_path) > MAX_FILE_BYTES:
        raise ValueError(f"{vocab_path} is over {MAX_FILE_BYTES} bytes")
    with open(vocab_path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _groups(column: pa.Array, limit: int, length) -> Iterator[tuple[int, int]]:
    """Row ranges of at most OUT_ROWS rows and about ``limit`` characters."""
    lo, held = 0, 0
    for i, n in enumerate(length(column)):
        if i > lo and (held + n > limit or i - lo >= OUT_ROWS):
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(column):
        yield lo, len(column)


def _lengths(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc
    return pc.binary_length(column).fill_null(0).to_pylist()


def encode(docs: DataFrame, vocab_path: str, text_col: str = "text", ids_col: str = "ids",
           count_col: str = "n_tokens", decoded_col: str | None = None) -> DataFrame:
    """docs with ``ids_col`` (binary, little-endian unsigned 32-bit ids) and
    ``count_col`` (long) in place of ``text_col``; with ``decoded_col`` also the
    text that decode() makes of the ids, in the same pass. The vocabulary is a
    tokenizer file at ``vocab_path``, read once on the driver. Existing columns
    of these names are replaced."""
    source = _source(docs, vocab_path)
    new = {ids_col: "binary", count_col: "long", **({decoded_col: "string"} if decoded_col else {})}
    keep = [c for c in docs.columns if c != text_col and c not in new]
    src = docs.select(*(F.col(f"`{c}`") for c in keep),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(source)
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            for lo, hi in _groups(text, GROUP_CHARS, _lengths):
                ids = bpe.encode(text.slice(lo, hi - lo).to_pylist())
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(keep))), pa.array(ids, pa.binary()),
                     pa.array([len(x) // 4 for x in ids], pa.int64()),
                     *([pa.array(map(bpe.decode, ids), pa.string())] if decoded_col else [])], [*keep, *new])
        bpe.forget()

    return src.mapInArrow(run, widened(src.drop("__text"), **new))


def decode(tokens: DataFrame, vocab_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """tokens with ``text_col``, the text of ``ids_col``; null ids give null."""
    source = _source(tokens, vocab_path)
    keep = [c for c in tokens.columns if c != text_col]
    src = tokens.select(*(F.col(f"`{c}`") for c in keep))
    at = keep.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(source)
        for batch in batches:
            for lo, hi in _groups(batch.column(at), 4 * GROUP_CHARS, _lengths):
                part = batch.slice(lo, hi - lo)
                text = [None if x is None else bpe.decode(x) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())], [*keep, text_col])

    return src.mapInArrow(run, widened(src, **{text_col: "string"}))
