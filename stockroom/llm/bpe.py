"""Byte-level BPE by speculation and verification.

For each new word a greedy longest match proposes tokens. Every adjacent pair
is then checked: the pair stands if no merge across its boundary would have
come before the merges that formed the two tokens. All pairs of a batch are
checked together in numpy. Words with a failing pair get exact merging.

A word is the unit of the tokenizer's own pre-tokenisation. Texts are first
cut into runs between white space (with the one leading space that belongs to
a word); ids of a run are remembered per worker up to ``cache_size`` runs.

Defined results: null and empty texts have no tokens and decode to "";
special tokens inside a text are found first, as the library does. Ids are
unsigned 32-bit; unknown ids decode to nothing. Bytes that are not UTF-8 decode
to U+FFFD per maximal invalid part. Text length is bounded by memory only.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import re
from pyspark.sql import DataFrame, SparkSession

from stockroom.llm.textbytes import Memo, column

#: Pre-tokenisation of byte-level BPE (public, fixed pattern).
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_WS = " \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUN = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")
#: White space other than a lone space or line feed: such texts are cut by RUN.
_ODD = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", "\x00")
_ODD_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
NEVER = 1 << 62
#: Longer words are merged from a heap, whose time is not quadratic.
HEAP_FROM = 256


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in vocabulary files: printable Latin-1
    stands for itself, the others follow from 256 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def run_keys(text: str) -> list[str]:
    """Runs of a text as cache keys. A key is the run behind ``\\x00``; keys
    without that mark are short forms: ``\\n`` and a word without a space, or
    else a word whose leading space is left out."""
    if not text:
        return []
    if (text[0] in " \n" or text[-1] == " " or any(o in text for o in _ODD)
            or not text.isascii() and _ODD_WIDE.search(text)):
        return ["\x00" + r for r in RUN.findall(text)]
    return ("\x00" + text).replace("\n", " \n").split(" ")


def _run(key: str) -> str:
    return key[1:] if key[0] == "\x00" else key if key[0] == "\n" else " " + key


class ByteBpe:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, cache_size: int = 500_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda t: bytes(alphabet[c] for c in t)
        self.vocab = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) \
            if self.added else None
        size = max([*self.vocab.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for t, i in self.vocab.items():
            self.bytes_of[i] = t
        for t, i in self.added.items():
            self.bytes_of[i] = t.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.made_at: list[int] = []
        self.single = [self.vocab.get(bytes([c]), 0) for c in range(256)]
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            a, b = raw(a), raw(b)
            pair = (self.vocab[a], self.vocab[b])
            self.rank[pair] = r
            self.made_at.append(self.vocab[a + b])
        self._prepare(size)
        self.cache, self.words = Memo(cache_size), Memo(cache_size)

    def _merge(self, word: bytes, parents: dict | None = None) -> list[int]:
        """Exact merging: lowest rank first, leftmost first among equals."""
        if len(word) >= HEAP_FROM and parents is None:
            return self._merge_long(word)
        one, rank = self.single, self.rank
        ids = [one[c] for c in word]
        ranks = [rank.get(p, NEVER) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            k = ranks.index(best)
            new = self.made_at[best]
            if parents is not None:
                parents[new] = (ids[k], ids[k + 1], best)
            ids[k:k + 2] = [new]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = rank.get((new, ids[k + 1]), NEVER)
            if k:
                ranks[k - 1] = rank.get((ids[k - 1], new), NEVER)
        return ids

    def _merge_long(self, word: bytes) -> list[int]:
        """The same for a long word: candidates wait in a heap, and one whose
        symbols have changed meanwhile is passed over."""
        rank, n = self.rank, len(word)
        ids = [self.single[c] for c in word]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))   # neighbours; n: none
        heap = [(r, k) for k, p in enumerate(zip(ids, ids[1:])) if (r := rank.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            nxt = after[k]
            if ids[k] < 0 or nxt >= n or rank.get((ids[k], ids[nxt])) != r:
                continue
            ids[k], ids[nxt] = self.made_at[r], -1
            after[k] = nxt = after[nxt]
            if nxt < n:
                before[nxt] = k
                if (new := rank.get((ids[k], ids[nxt]))) is not None:
                    heapq.heappush(heap, (new, k))
            if (left := before[k]) >= 0 and (new := rank.get((ids[left], ids[k]))) is not None:
                heapq.heappush(heap, (new, left))
        return [i for i in ids if i >= 0]

    def _prepare(self, size: int) -> None:
        """Edges of each token's derivation: the symbols that stand at its
        right and left end over time, each with the rank that replaces it."""
        split = {}
        for (a, b), r in self.rank.items():
            new = self.made_at[r]
            if new not in split or r < split[new][2]:
                split[new] = (a, b, r)
        #: Only tokens that merging itself reaches from their own bytes are proposed.
        self.greedy = {}
        for t, i in self.vocab.items():
            if len(t) == 1:
                self.greedy[t] = i
            elif i in split:
                seen: dict = {}
                if self._merge(t, seen) == [i] and all(seen[x][:2] == split[x][:2] for x in seen):
                    self.greedy[t] = i
        #: Longest proposed token for each beginning of four bytes.
        self.reach: dict[bytes, int] = {}
        for t in self.greedy:
            if len(t) >= 4:
                self.reach[t[:4]] = max(len(t), self.reach.get(t[:4], 4))
        edges = {}
        for side in (0, 1):   # 0: left end, 1: right end
            chains = [[] for _ in range(size)]
            for t, i in self.greedy.items():
                chain, x, dies = [], i, NEVER
                while True:
                    chain.append((x, dies))
                    if x not in split or len(self.bytes_of[x]) == 1:
                        break
                    dies = split[x][2]
                    x = split[x][side]
                chains[i] = chain[::-1]
            depth = max(map(len, chains))
            sym = np.full((size, depth), -1, np.int64)
            die = np.full((size, depth), NEVER, np.int64)
            for i, c in enumerate(chains):
                for k, (x, d) in enumerate(c):
                    sym[i, k], die[i, k] = x, d
            edges[side] = (sym, die, np.array([max(0, len(c) - 1) for c in chains]))
        self.left, self.right = edges[0], edges[1]
        keys = np.array([a * size + b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        self.pair_key = keys[order]
        self.pair_rank = np.array(list(self.rank.values()), np.int64)[order]
        self.size = size

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: does merging leave the boundary alone?

        Walks up the symbols next to the boundary in order of time; ``a`` loses
        if a merge across comes before both neighbours are replaced."""
        rs, rd, rtop = self.right
        ls, ld, ltop = self.left
        i, j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y, ii, jj = a[live], b[live], i[live], j[live]
            key = rs[x, ii] * self.size + ls[y, jj]
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            across = np.where(self.pair_key[at] == key, self.pair_rank[at], NEVER)
            dx, dy = rd[x, ii], ld[y, jj]
            bad = (across < dx) & (across <= dy) & (across < NEVER)
            good[live[bad]] = False
            # On equal ranks the left word's merge is the first one.
            left_first = dx <= dy
            i[live] = ii + left_first
            j[live] = jj + ~left_first
            done = bad | ((ii >= rtop[x]) & (jj >= ltop[y]))
            live = live[~done]
        return good

    def propose(self, word: bytes) -> list[int]:
        out, i, n, greedy, reach = [], 0, len(word), self.greedy, self.reach
        while i < n:
            j = i + reach.get(word[i:i + 4], 3)
            t = greedy.get(word[i:j])
            while t is None:
                j = (n if j > n else j) - 1
                t = greedy.get(word[i:j])
            out.append(t)
            i = j if j < n else n
        return out

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: propose, verify all pairs, merge what fails."""
        found = [self.propose(w) for w in words]
        flat = np.fromiter((t for f in found for t in f), np.int64)
        lengths = np.array([len(f) for f in found], np.int64)
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(found)), lengths)
            inner = owner[1:] == owner[:-1]
            keys = flat[:-1][inner] * self.size + flat[1:][inner]
            uniq, back = np.unique(keys, return_inverse=True)
            good = self.compatible(uniq // self.size, uniq % self.size)[back]
            for w in np.unique(owner[1:][inner][~good]).tolist():
                found[w] = self._merge(words[w])
        return found

    def _learn(self, keys: list[str]) -> None:
        """Fill the cache: runs that differ in punctuation share their words."""
        split = [WORD.findall(_run(k)) for k in keys]
        new = self.words.missing(set().union(*split))
        known = self.words.now
        for w, ids in zip(new, self.encode_words([w.encode() for w in new])):
            known[w] = array("I", ids).tobytes()
        cache = self.cache.now
        for k, ws in zip(keys, split):
            cache[k] = known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts: list[list] = []
        for t in texts:
            if self.special is not None and "<" in t and self.special.search(t):
                one, at = [], 0
                for m in self.special.finditer(t):
                    one += run_keys(t[at:m.start()])
                    one.append(self.added[m.group()])
                    at = m.end()
                one += run_keys(t[at:])
            else:
                one = run_keys(t)
            parts.append(one)
        new = self.cache.missing({k for k in set().union(*parts) if not isinstance(k, int)})
        if new:
            self._learn(new)
        cache = self.cache.now
        out = []
        for one in parts:
            try:
                out.append(b"".join(map(cache.__getitem__, one)))
            except KeyError:   # ids of special tokens stand in the list themselves
                out.append(b"".join(k.to_bytes(4, "little") if isinstance(k, int) else cache[k] for k in one))
        return out

    def decode_bytes(self, ids: bytes) -> bytes:
        table, n = self.bytes_of, len(self.bytes_of)
        listed = np.frombuffer(ids, "<u4").tolist()
        try:
            return b"".join(map(table.__getitem__, listed))
        except IndexError:
            return b"".join(table[i] for i in listed if i < n)

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_LOADED: dict[str, ByteBpe] = {}


def loaded(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def text_parts(texts: list[str], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` characters."""
    i, total = 0, 0
    for j, t in enumerate(texts):
        total += len(t)
        if total >= limit:
            yield i, j + 1
            i, total = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, ``ids`` (array of int) of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            texts = [t or "" for t in column(batch, text_col).to_pylist()]
            for i, j in text_parts(texts):
                ids = [np.frombuffer(b, "<u4").astype(np.int32) for b in bpe.encode_batch(texts[i:j])]
                yield pa.RecordBatch.from_arrays(
                    [column(batch, id_col).slice(i, j - i), pa.array(ids, pa.list_(pa.int32()))],
                    names=[id_col, "ids"])
    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """id, ``text`` from a column ``ids`` (null: null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            out = [None if ids is None else bpe.decode(np.array(ids, "<u4").tobytes())
                   for ids in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, id_col), pa.array(out, pa.string())],
                                             names=[id_col, "text"])
    kind = dict(encoded.dtypes)[id_col]
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, text string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one
    pass without keeping the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            texts = [t or "" for t in column(batch, "text").to_pylist()]
            n, a, b = [], [], []
            for i, j in text_parts(texts):
                for ids in bpe.encode_batch(texts[i:j]):
                    n.append(len(ids) // 4)
                    a.append(hashlib.sha256(ids).hexdigest())
                    b.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of ids and of the decoded text of every document."""
    import public_tokenizers
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         public_tokenizers.path("byte_bpe_50k.json"))
