"""Byte-level BPE encoding and decoding.

The bytes of all words of a portion of texts start as doubly linked lists of
symbols. One priority queue holds the merge ranks of neighbouring pairs, each
with its places; the lowest rank is merged first, leftmost on overlaps, and a
place whose two symbols are no longer the neighbours it was queued for is
stale and skipped. A merge only makes pairs of higher rank, so one queue
serves all words at once and every rank's places are merged as arrays. The
work is n log n whatever the length of a word. Decoding concatenates
vocabulary strings.

Texts are cut at single spaces between two other characters, where no
pre-token can cross, and each distinct piece of a portion is encoded once; a
bounded cache keeps pieces that return. A text with longer runs of white space
is cut by the pattern.

Defined cases: null and empty texts give no ids and the empty text; special
tokens written in a text become their ids, as the tokenizer file asks; a null
id is carried; repeated rows stay; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import kept, map_batches, narrow

#: Fixed pattern of byte-level pre-tokenising.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_PIECES = 400_000  # of each of two generations


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        self.byte_ids = np.array([vocab[x] for x in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.made = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]  # by rank
        keys = np.array([a << 32 | b for a, b, _ in self.made], np.int64)
        self.rank_at = np.argsort(keys)
        self.keys = keys[self.rank_at]
        byte_of = {x: b for b, x in enumerate(letters)}
        self.ids = np.arange(max(vocab.values()) + 1).astype(object)  # one number object per id, shared by all that is known
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.strings: dict[int, bytes] = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items() if s not in self.added}
        self.strings |= {i: s.encode() for s, i in self.added.items()}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, tuple[int, ...]] = {}  # pre-token or, after a space, piece
        self.older: dict[str, tuple[int, ...]] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 for none."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_at[at], -1)

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each pre-token, all through one queue."""
        ends = np.cumsum([len(w) for w in words])
        n = int(ends[-1]) if len(words) else 0
        if not n:
            return [()] * len(words)
        symbol = np.append(self.byte_ids[np.frombuffer(b"".join(words), np.uint8)], np.int32(-1))  # place n stands for no neighbour
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        after[ends[ends > 0] - 1] = n
        before[ends[ends < n]] = n
        before[0] = n
        ranks = self._ranks(symbol[:n], symbol[after[:n]])
        places = np.flatnonzero(ranks >= 0)
        places = places[np.argsort(ranks[places], kind="stable")]
        heap, starts = np.unique(ranks[places], return_index=True)
        heap = heap.tolist()
        queue = dict(zip(heap, np.split(places, starts[1:])))
        while heap:
            rank = heapq.heappop(heap)
            left, right, whole = self.made[rank]
            at = np.unique(queue.pop(rank))
            at = at[(symbol[at] == left) & (symbol[after[at]] == right)]  # the others are stale
            if not len(at):
                continue
            if left == right and len(at) > 1:  # of overlapping places the leftmost merges
                kept, dead = [], -1
                for place, partner in zip(at.tolist(), after[at].tolist()):
                    if place != dead:
                        kept.append(place)
                        dead = partner
                at = np.array(kept)
            gone = after[at]
            follow = after[gone]
            symbol[at], symbol[gone] = whole, -1
            after[at], before[follow] = follow, at
            ahead = before[at]
            fresh = np.concatenate([ahead[ahead < n], at])
            new = self._ranks(symbol[fresh], symbol[after[fresh]])
            hit = new >= 0
            for rank, place in zip(new[hit].tolist(), fresh[hit].tolist()):
                if rank in queue:
                    queue[rank].append(place) if isinstance(queue[rank], list) else queue.__setitem__(rank, [*queue[rank], place])
                else:
                    queue[rank] = [place]
                    heapq.heappush(heap, rank)
        alive = symbol[:n] >= 0
        ids = self.ids[symbol[:n][alive]].tolist()
        cuts = [0, *np.cumsum(alive)[ends[ends > 0] - 1].tolist()]
        made = (tuple(ids[a:b]) for a, b in zip(cuts, cuts[1:]))
        return [next(made) if w else () for w in words]

    def _words(self, piece: str) -> list[str]:
        """Pre-tokens of a text, or of a piece with its space in front."""
        body = piece[1:]
        if body.isalpha():
            return [piece] if piece[0] == " " else self.pattern.findall(piece)
        if body[-1:] in (".", ",") and piece[0] == " " and body[:-1].isalpha():
            return [piece[:-1], body[-1]]
        return self.pattern.findall(piece)

    def _learn(self, pieces: set[str]) -> None:
        """Make the ids of all pieces known."""
        known, older = self.known, self.older
        if len(known) > CACHE_PIECES:
            self.older = older = known
            self.known = known = {}
        missing = pieces - known.keys()
        known |= {p: older[p] for p in missing & older.keys()}
        cut = {p: self._words(p) for p in missing - known.keys()}
        words = set(chain.from_iterable(cut.values()))
        words -= known.keys()
        again = words & older.keys()
        known |= {w: older[w] for w in again}
        words = list(words - again)
        known |= zip(words, self.merge([w.encode() for w in words]))
        known |= {p: tuple(chain.from_iterable(known[w] for w in ws)) for p, ws in cut.items() if p not in known}

    def _pieces(self, text: str) -> list[str]:
        head, *rest = text.split(" ")
        if any(not p or p[0].isspace() or p[-1].isspace() for p in rest) or not head or head[-1].isspace():
            return self.pattern.findall(text)
        return [head, *[" " + p for p in rest]]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        number = defaultdict(lambda: len(number))  # of each distinct piece; a text is kept as numbers, not as strings
        cut: list[array] = []
        for text in texts:
            if not text:
                pieces = []
            elif self.split_added is None or not self.split_added.search(text):
                pieces = self._pieces(text)
            else:
                pieces = chain.from_iterable(([p] if p in self.added else self._pieces(p)) for p in self.split_added.split(text) if p)
            cut.append(array("i", map(number.__getitem__, pieces)))
        self._learn(number.keys() - self.added.keys())
        known = self.known
        if not self.added.keys() <= known.keys():
            known |= {s: (i,) for s, i in self.added.items()}
        coded = [known[p] for p in number]
        return [list(chain.from_iterable(map(coded.__getitem__, numbers))) for numbers in cut]

    def decode(self, ids) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def _loaded(shared) -> Bpe:
    """The coder of a broadcast tokenizer file, built once per worker and kept until other work comes."""
    return kept(shared.id, lambda: Bpe(shared.value))


class _Shared:
    """A broadcast and its number (a tokenizer file is a few MB, whatever the corpus)."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            self.broadcast = spark.sparkContext.broadcast(f.read())
        self.id = hash(self.broadcast._jbroadcast.id())

    @property
    def value(self):
        return self.broadcast.value


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _flat(lists: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.fromiter(chain.from_iterable(lists), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(df: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>), and with `decoded` the text that the ids decode to, in one pass."""
    shared = _Shared(df.sparkSession, tokenizer or default_tokenizer())

    def run(batch):
        coder = _loaded(shared)
        ids = coder.encode(batch.column("text").to_pylist())
        arrays = [batch.column("doc_id"), _flat(ids)]
        if decoded:
            arrays.append(pa.array([coder.decode(x) for x in ids], pa.string()))
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "decoded"][:len(arrays)])
    return map_batches(narrow(df, id_col, text_col), run, "doc_id long, ids array<int>" + ", decoded string" * decoded, owner=shared.id)


def decode(df: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) of a table of ids; null ids decode to the empty text."""
    shared = _Shared(df.sparkSession, tokenizer or default_tokenizer())

    def run(batches):
        coder = _loaded(shared)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([coder.decode(x or ()) for x in batch.column(1).to_pylist()], pa.string())],
                                             names=["doc_id", "decoded"])
    flat = df.select(df[id_col].cast("long").alias("doc_id"), df[ids_col].cast("array<int>").alias("ids"))
    return flat.mapInArrow(run, "doc_id long, decoded string")


def digests(df: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Token counts and checksums of the ids and the decoded text of every document, with the ids if asked for."""
    coded = encode(df, tokenizer, decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), *["ids"] * with_ids)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
