"""SentencePiece encoding and decoding by a batched numpy Viterbi pass.

Words (a run of spaces and the characters up to the next space) of similar
length form a matrix and advance together, character by character: the hashes
of all substrings that end at a position probe the sorted piece keys, a
vectorised maximum over them picks the best last piece, and its length is the
backpointer.

For a unigram model the maximum is over the sums of scores. A BPE model merges
the best-scored pair first, which the sum does not reproduce, so there the
score of a path is 1 if every two neighbouring pieces are what BPE would leave
side by side and 0 else: exactly one last piece of each prefix has score 1,
and the path is BPE's own. Runs of several spaces, whose pieces all have the same
score, are merged pair by pair.

The vocabulary is read from a SentencePiece model file on the driver; tasks get
its arrays. Nothing is trained.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.common import ids_as_text, ids_back
from tripdemand.llm.text_hash import mix64

MARK = "▁"
_WORD = re.compile(" *[^ ]+| +")
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Fixed values of the model format: kinds of pieces and models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Words are padded to the next of these lengths (then to powers of two).
LENGTHS = (4, 6, 8, 10, 12, 16, 24, 32, 48, 64)
#: Words that an encoder keeps, and characters of texts that it cuts into words at a time: what a worker holds beside its batch.
CACHE_WORDS = 1 << 18
SLICE_CHARS = 1 << 19
#: Slots of the marks by which most substrings that are no piece are passed over before the search.
MARK_SLOTS = 1 << 20
#: Slots of the table of pairs already decided, and the mark of an empty one.
PAIR_SLOTS = 1 << 20
NO_PAIR = np.uint64(0xFFFFFFFFFFFFFFFF)


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            shift += 7
            at += 1
            if raw[at - 1] < 128:
                return value, at

    at = 0
    while at < len(raw):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = raw[at:at + size], at + size
        yield tag >> 3, value


def in_order(places: np.ndarray, flat: np.ndarray, sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat``, of these sizes, put in the order of their places (of one place: as they come), and the size of each of n places."""
    order = np.argsort(places, kind="stable")
    size = sizes[order]
    starts = (np.cumsum(sizes) - sizes)[order]
    at = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
    return flat[at], np.bincount(places, weights=sizes, minlength=n).astype(np.int64)


class PieceModel:
    """Arrays of a SentencePiece model: what the Viterbi pass and decoding need.

    About 4 MB for 32,000 pieces; it travels with the task's function.
    """

    def __init__(self, raw: bytes):
        pieces, scores, kinds = [], [], []
        self.kind, prefix, squeeze, charsmap = UNIGRAM, True, True, b""
        for field, value in _fields(raw):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                spec = dict(_fields(value))
                charsmap, prefix, squeeze = spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if self.kind not in (UNIGRAM, BPE) or charsmap or squeeze:
            raise ValueError("only unigram and BPE models without normalisation rules are supported")
        self.prefix, self.size = prefix, len(pieces)
        self.scores = np.array(scores + [min(scores, default=0.0) - 10.0], np.float64)
        self.unknown = next((i for i, k in enumerate(kinds) if k == UNKNOWN), 0)
        text_of = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k in (NORMAL, USER)}
        self.byte_ids = np.full(256, -1, np.int32)
        data = []
        for i, (p, k) in enumerate(zip(pieces, kinds)):
            if k == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
                data.append(bytes([int(p[3:5], 16)]))
            else:
                data.append(p.replace(MARK, " ").encode() if k in (NORMAL, USER) else b"")
        self.data = np.frombuffer(b"".join(data), np.uint8)
        self.ends = np.cumsum([len(d) for d in data])
        if self.kind == BPE:
            self._merges(text_of)
            text_of = {p: i for p, i in text_of.items() if len(p) == 1 or self.left[i] >= 0}
        self.longest = max(map(len, text_of), default=1)
        keys = np.array([self.hash_of(p) for p in text_of], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.fromiter(text_of.values(), np.int64, len(text_of))[order]
        self.marks = np.zeros(1, bool)
        self.asked, self.answers = np.full(1, NO_PAIR), np.zeros(1, bool)
        self.bigrams = np.unique(np.array(
            [ord(a) << 32 | ord(b) for p in text_of for a, b in zip(p, p[1:])] or [0], np.uint64))

    @staticmethod
    def hash_of(piece: str) -> int:
        h = 0
        for c in mix64(np.array([ord(c) + 1 for c in piece], np.uint64)).tolist():
            h = (h * int(_BASE) + c) & (1 << 64) - 1
        return h

    def _merges(self, text_of: dict[str, int]) -> None:
        """Merge order, the last merge of each piece, and the table of mergeable pairs."""
        n = self.size
        self.rank = np.full(n + 1, -1, np.int64)
        self.left, self.right = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
        self.text_of = text_of
        many = sorted((p for p in text_of if len(p) > 1), key=lambda p: (-self.scores[text_of[p]], text_of[p]))
        pairs: dict[int, int] = {}
        for r, p in enumerate(many):
            self.rank[text_of[p]] = r
        spaces = {p for p in many if not p.strip(MARK)}
        splits = {p: [(text_of[p[:k]], text_of[p[k:]]) for k in range(1, len(p))
                      if p[:k] in text_of and p[k:] in text_of] for p in many}
        for p in many:
            for a, b in splits[p]:
                pairs[a << 32 | b] = int(self.rank[text_of[p]])
        table = {}
        for p in many:  # in merge order: the parts of a piece are settled before it
            i = text_of[p]
            for a, b in splits[p]:
                r = int(self.rank[i])
                if self.rank[a] < r and self.rank[b] < r and (
                        len(p) == 2 or p in spaces or self._side_by_side(a, b, table, r)):
                    self.left[i], self.right[i] = a, b
                    for x, y in splits[p]:
                        table[x << 32 | y] = r
                    break
        keys = np.array(sorted(table), np.uint64)
        self.pair_keys, self.pair_ranks = keys, np.array([table[int(k)] for k in keys], np.int64)

    def _side_by_side(self, a: int, b: int, table: dict[int, int], below: int) -> bool:
        """Would BPE leave pieces a and b next to each other, given the merges before ``below``?"""
        limit = below
        while True:
            if table.get(a << 32 | b, limit) < limit:
                return False
            if self.rank[a] > self.rank[b]:
                limit, a = int(self.rank[a]), int(self.right[a])
            else:
                if self.left[b] < 0:
                    return True
                limit, b = int(self.rank[b]) + 1, int(self.left[b])

    def side_by_side(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The same for many pairs at once and all merges; answers are kept in a direct-mapped table."""
        key = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        slot = mix64(key) & np.uint64(len(self.asked) - 1)
        new = self.asked[slot] != key
        out = self.answers[slot]
        if new.any():
            got = self._settle(key[new])
            out[new] = got
            self.asked[slot[new]] = key[new]
            # two new pairs may share a slot: whichever key was written last, its answer must be there
            self.answers[slot[new]] = got
            clash = self.asked[slot[new]] != key[new]
            if clash.any():
                self.asked[slot[new][clash]] = NO_PAIR
        return out

    def _settle(self, keys: np.ndarray) -> np.ndarray:
        """Undoes the later of the two pieces' last merges step by step: no pair that met at the
        boundary meanwhile may have been due first."""
        kinds, inverse = np.unique(keys, return_inverse=True)
        a, b = (kinds >> np.uint64(32)).astype(np.int64), (kinds & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ok, live = np.ones(len(kinds), bool), np.arange(len(kinds))
        limit = np.full(len(kinds), np.iinfo(np.int64).max)
        while len(live):
            key = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
            at = np.minimum(np.searchsorted(self.pair_keys, key), max(len(self.pair_keys) - 1, 0))
            early = (self.pair_keys[at] == key) & (self.pair_ranks[at] < limit) if len(self.pair_keys) else np.zeros(len(key), bool)
            ok[live[early]] = False
            ra, rb = self.rank[a], self.rank[b]
            undo_a = ra > rb
            go = ~early & (undo_a | (rb >= 0))
            limit = np.where(undo_a, ra, rb + 1)[go]
            a, b = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go]
            live = live[go]
        return ok[inverse]

    # ---- encoding -----------------------------------------------------------

    def _cut(self, word: str) -> list[str]:
        """A long word cut where no piece can reach across."""
        cp = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        key = cp[:-1] << np.uint64(32) | cp[1:]
        at = np.minimum(np.searchsorted(self.bigrams, key), len(self.bigrams) - 1)
        cuts = [0, *(np.flatnonzero(self.bigrams[at] != key) + 1).tolist(), len(word)]
        return [word[x:y] for x, y in zip(cuts, cuts[1:])]

    def _viterbi(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best pieces of words (escaped, none empty), batched by padded length: one after the other, and their numbers."""
        places, flats, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            n = len(w)
            size = next((x for x in LENGTHS if n <= x), None) or 1 << (n - 1).bit_length()
            groups.setdefault(size, []).append(i)
        for size, at in groups.items():
            step = max(1, (1 << 19) // (size * self.longest))
            for k in range(0, len(at), step):
                part = at[k:k + step]
                flat, number = self._advance([words[i] for i in part], size)
                places.append(np.array(part, np.int64))
                flats.append(flat)
                sizes.append(number)
        return in_order(np.concatenate(places), np.concatenate(flats), np.concatenate(sizes), len(words))

    def _advance(self, words: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
        n, longest = len(words), min(self.longest, size)
        cp = np.frombuffer("".join(w.ljust(size, "\0") for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size)
        code = mix64(cp.astype(np.uint64) + np.uint64(1))
        lengths = np.fromiter(map(len, words), np.int64, n)
        prefix = np.zeros((n, size + 1), np.uint64)
        for i in range(size):
            prefix[:, i + 1] = prefix[:, i] * _BASE + code[:, i]
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest, _BASE)]).astype(np.uint64), dtype=np.uint64)
        unknown, empty = self.size, -1
        last, back = np.full((n, size + 1), empty, np.int64), np.zeros((n, size + 1), np.int64)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0.0
        for i in range(1, size + 1):
            reach = np.arange(1, min(i, longest) + 1)
            key = prefix[:, i:i + 1] - prefix[:, i - reach] * power[reach]
            piece = self._lookup(key.ravel(), empty).reshape(key.shape)
            piece[:, 0] = np.where(piece[:, 0] < 0, unknown, piece[:, 0])
            before = last[:, i - reach]
            if self.kind == UNIGRAM:
                score = np.where(piece >= 0, best[:, i - reach] + self.scores[piece], -np.inf)
            else:
                score = np.where((piece >= 0) & (best[:, i - reach] >= 0), 0.0, -np.inf)
                ask = (score == 0) & (before >= 0)
                if ask.any():
                    score[ask] = np.where(self.side_by_side(before[ask], piece[ask]), 0.0, -np.inf)
            pick = score.argmax(axis=1)
            rows = np.arange(n)
            best[:, i], back[:, i], last[:, i] = score[rows, pick], reach[pick], piece[rows, pick]
        end = lengths.copy()
        live = np.arange(n)
        steps = []
        while len(live):
            e = end[live]
            steps.append((live, last[live, e], e))
            end[live] = e - back[live, e]
            live = live[end[live] > 0]
        rows, ids, ends = (np.concatenate([s[k] for s in reversed(steps)]) for k in range(3))
        sizes = np.ones(len(ids), np.int64)
        strange = np.flatnonzero(ids == unknown)
        if len(strange):
            spelt = [self._bytes(words[r][x - 1]) for r, x in zip(rows[strange].tolist(), ends[strange].tolist())]
            sizes[strange] = [len(b) for b in spelt]
            ids = np.repeat(ids, sizes)
            ids[ids == unknown] = [i for b in spelt for i in b]
        return in_order(rows, ids.astype(np.int32), sizes, n)

    def _lookup(self, keys: np.ndarray, empty: int) -> np.ndarray:
        """Ids of the pieces with these hashes, ``empty`` where there is none."""
        if len(self.marks) != MARK_SLOTS:
            self.marks = np.zeros(MARK_SLOTS, bool)
            self.marks[self.keys & np.uint64(MARK_SLOTS - 1)] = True
        out = np.full(len(keys), empty, np.int64)
        marked = np.flatnonzero(self.marks[keys & np.uint64(MARK_SLOTS - 1)])
        asked = keys[marked]
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        out[marked] = np.where(self.keys[at] == asked, self.ids[at], empty)
        return out

    def _bytes(self, char: str) -> list[int]:
        ids = self.byte_ids[list(char.encode("utf-8", "surrogatepass"))]
        return ids.tolist() if (ids >= 0).all() else [self.unknown]

    def _merge(self, word: str) -> np.ndarray:
        """BPE pair by pair, for words that hold a run of spaces: best score first, then leftmost."""
        import heapq
        part = list(word)
        before, after = list(range(-1, len(part) - 1)), list(range(1, len(part) + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else len(part)
            if i >= 0 and j < len(part):
                p = part[i] + part[j]
                if p in self.text_of:
                    heapq.heappush(heap, (-float(self.scores[self.text_of[p]]), i, j, p))

        for i in range(len(part)):
            offer(i)
        while heap:
            _, i, j, p = heapq.heappop(heap)
            if part[i] and part[j] and after[i] == j and part[i] + part[j] == p:
                part[i], part[j] = p, ""
                after[i] = after[j]
                if after[j] < len(part):
                    before[after[j]] = i
                offer(before[i])
                offer(i)
        ids: list[int] = []
        for p in part:
            if p:
                ids.extend([self.text_of[p]] if p in self.text_of else self._bytes(p))
        return np.array(ids, np.int32)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of raw words (spaces not yet escaped), one after the other, and their numbers."""
        merged: list[np.ndarray] = []
        apart, cut, owner = [], [], []
        for i, w in enumerate(words):
            w = w.replace(" ", MARK)
            if self.kind == BPE and MARK + MARK in w:
                head = len(w) - len(w.lstrip(MARK)) + 2 * self.longest
                parts = self._cut(w[head:]) if len(w) > 4 * self.longest else []
                apart.append(i)
                if len(parts) > 1:  # only the run and what follows it up to a safe cut goes pair by pair
                    merged.append(np.concatenate([self._merge(w[:head] + parts[0]), self._viterbi(parts[1:])[0]]))
                else:
                    merged.append(self._merge(w))
            elif len(w) > 24:
                parts = self._cut(w)
                cut += parts
                owner += [i] * len(parts)
            else:
                cut.append(w)
                owner.append(i)
        flat, sizes = self._viterbi(cut)
        return in_order(np.array(owner + apart, np.int64), np.concatenate([flat, *merged]),
                        np.concatenate([sizes, np.array([len(m) for m in merged], np.int64)]), len(words))

    def decode(self, ids: np.ndarray) -> str:
        """Text of pieces; byte pieces join to UTF-8 (broken sequences become U+FFFD)."""
        if not len(ids):
            return ""
        size = np.diff(self.ends, prepend=0)[ids]
        at = np.repeat(self.ends[ids] - np.cumsum(size), size) + np.arange(size.sum())
        text = self.data[at].tobytes().decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


class Encoder:
    """Encodes texts; words seen before come from a table that is cleared when it is full."""

    def __init__(self, model: PieceModel):
        self.model = model
        model.asked, model.answers = np.full(PAIR_SLOTS, NO_PAIR), np.zeros(PAIR_SLOTS, bool)
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text, in slices of ``SLICE_CHARS`` characters (a longer text is one of its own)."""
        out: list[np.ndarray] = []
        part: list[str | None] = []
        chars = 0
        for t in texts:
            if part and chars + len(t or "") > SLICE_CHARS:
                out += self._encode(part)
                part, chars = [], 0
            part.append(t)
            chars += len(t or "")
        return out + self._encode(part)

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.index) > CACHE_WORDS:
            self._clear()
        lead = " " if self.model.prefix else ""
        split = [_WORD.findall(lead + t.replace(MARK, " ")) if t else [] for t in texts]
        index = self.index
        new = list(dict.fromkeys(w for ws in split for w in ws if w not in index))
        if new:
            flat, sizes = self.model.encode_words(new)
            index.update(zip(new, range(len(index), len(index) + len(new))))
            self.flat = np.concatenate([self.flat, flat])
            self.sizes = np.concatenate([self.sizes, sizes])
        starts = np.cumsum(self.sizes) - self.sizes
        out = []
        for ws in split:
            w = np.fromiter(map(index.__getitem__, ws), np.int64, len(ws))
            size = self.sizes[w]
            at = np.repeat(starts[w] - np.cumsum(size) + size, size) + np.arange(size.sum())
            out.append(self.flat[at])
        return out


def load_model(path: str) -> PieceModel:
    with open(path, "rb") as f:
        return PieceModel(f.read())


def encode_texts(documents: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``documents`` with ids (array<int>) and n_tokens (long); columns of these names are replaced.

    Null and empty texts have no tokens. The model file is read on the driver
    alone. A literal U+2581 counts as a space, as in the model's own escape.
    """
    model = load_model(model_path)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(model)
        for texts in batches:
            yield pd.Series(encoder.encode(list(texts)), dtype=object)

    return documents.withColumn("ids", encode(F.col(text))).withColumn("n_tokens", F.size("ids").cast("long"))


def decode_ids(frame: DataFrame, model_path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``frame`` with the text of its token ids; null ids give null, no ids the empty text."""
    model = load_model(model_path)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series([None if r is None else model.decode(np.asarray(r, np.int64)) for r in rows], dtype=object)

    return frame.withColumn(into, decode(F.col(ids)))


def encode_digest(documents: DataFrame, model_path: str) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_tokens, ids_sha256 (of the ids as
    little-endian 32-bit integers), round_trip (the decoded ids are the text, U+2581 as space).

    One pass encodes, decodes and compares. Null texts have no tokens and count
    as the empty text. Rows with a null doc_id and repeated rows are kept.
    """
    model = load_model(model_path)
    docs = documents.select("doc_id", "text")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(model)
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            ids = encoder.encode(texts)
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].to_numpy(), "n_tokens": [len(x) for x in ids],
                "ids_sha256": [hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids],
                "round_trip": [model.decode(x) == t.replace(MARK, " ") for x, t in zip(ids, texts)]})

    out = ids_as_text(docs, "doc_id").mapInPandas(digest, "doc_id string, n_tokens long, ids_sha256 string, round_trip boolean")
    return ids_back(out, "doc_id", docs)
