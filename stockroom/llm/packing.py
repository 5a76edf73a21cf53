"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token pieces of at most ``capacity`` tokens. Pieces are dealt
by hash into regions of bounded size. In each region several islands evolve
packings: crossover injects whole well-filled bins of one parent into another,
drops the bins they overlap and places the displaced pieces by best fit,
longest first. The first packings are best fits in an order by chance, some
percent above the least possible number of bins; crossover and mutation bring
them there. After an epoch each island's elite moves to the next island of
its region; after the last epoch the region's best packing is taken.

Defined results: null and empty texts are one piece with the end token alone;
rows with equal ids are packed separately; empty tables give no rows. A region
leaves at most about one bin unfilled, so regions cost under one bin in a
thousand.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockroom.llm.textbytes import U64, Memo, column, mix64, slices, string_bytes, word_spans
from stockroom.session import ensure_checkpoint_dir

CAPACITY, REGION_ITEMS, ISLANDS, EPOCHS = 2048, 4096, 3, 2
POPULATION, GENERATIONS = 4, 40
SLICE_BYTES = 1 << 20


#: Runs of these letters and signs alone are their own NFC form, and their
#: lower case goes letter by letter.
PLAIN = re.compile(r"[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
#: The tokenizer's own pre-tokenisation for such lower-case runs (fixed pattern).
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xe0-\xf6\xf8-\xff\xdf]+|[0-9]|[^a-z\xe0-\xf6\xf8-\xff\xdf0-9]+")


class WordTokenizer:
    """The library's ids, remembered per run between ASCII white space (the
    tokenizer drops white space and no token of it crosses any) and, for plain
    runs, per word, so that runs that differ in signs and case share them."""

    def __init__(self, path: str, cache_size: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence
        from tokenizers.pre_tokenizers import ByteLevel, Sequence as Steps, WhitespaceSplit
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        # Plain words are normalised and cut already: the model alone is left.
        self.model = Tokenizer.from_str(self.lib.to_str())
        self.model.normalizer = Sequence([])
        self.model.pre_tokenizer = Steps([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        # Whether a token ends a word.
        vocab, suffix = self.lib.get_vocab(), json.loads(self.lib.to_str())["model"].get("end_of_word_suffix")
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        self.cache, self.words = Memo(cache_size), Memo(cache_size)
        self.table = WordTable(2 * cache_size)

    def _ids(self, lib, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, runs: list[bytes]) -> None:
        plain, odd, split = [], [], []
        for r in runs:
            t = r.decode()
            if PLAIN.fullmatch(t) and "<|" not in t:
                plain.append(r)
                split.append(WORD.findall(t.lower()))
            else:
                odd.append(r)
        new = self.words.missing(set().union(*split))
        words = self.words.now
        words.update(zip(new, self._ids(self.model, new)))
        cache = self.cache.now
        for r, ws in zip(plain, split):
            cache[r] = words[ws[0]] if len(ws) == 1 else b"".join([words[w] for w in ws])
        cache.update(zip(odd, self._ids(self.lib, [r.decode() for r in odd])))

    def runs(self, runs: list[bytes]) -> list[bytes]:
        """Ids of whole runs, little-endian 32-bit."""
        new = self.cache.missing(set(runs))
        for i in range(0, len(new), 50_000):
            self._learn(new[i:i + 50_000])
        return list(map(self.cache.now.__getitem__, runs))

    def plain_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are normalised and cut already."""
        out = []
        for i in range(0, len(words), 1000):      # one text of many words, told apart by their last tokens
            some = words[i:i + 1000]
            text = b" ".join(some).decode()
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            till = np.flatnonzero(self.last[ids]) + 1
            if len(till) != len(some):
                out += self._ids(self.model, text.split(" "))
                continue
            body = ids.tobytes()
            out += [body[4 * a:4 * b] for a, b in zip([0, *till[:-1].tolist()], till.tolist())]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids begin.

        Plain runs are put in lower case and cut into words as arrays. Words of
        up to 16 bytes are looked up as two numbers each, all at once; those that
        the table does not hold yet, longer ones and other runs go one by one."""
        lower, starts, ends, plain = _units(data, offsets)
        size = ends - starts
        low, high = _eight_bytes(lower, starts, size), _eight_bytes(lower, starts + 8, size - 8)
        key = mix64(low ^ mix64(high + size.astype(np.uint64)))
        table, short = self.table, plain & (size <= 16)
        known, source, count = table.find(key, low, high, size, short)
        body, low_body = data.tobytes(), lower.tobytes()
        new = np.flatnonzero(short & ~known)
        if len(new):
            new = new[np.unique(key[new], return_index=True)[1]]
            moved = table.add(key[new], low[new], high[new], size[new],
                              self.plain_words([low_body[i:j] for i, j in zip(starts[new].tolist(), ends[new].tolist())]))
            if moved:
                known, source, count = table.find(key, low, high, size, short)
            else:
                more, start, n = table.find(key, low, high, size, short & ~known)
                known, source, count = known | more, source + start, count + n
        rest = np.flatnonzero(~known)
        is_word = plain[rest].tolist()
        cut = list(zip(starts[rest].tolist(), ends[rest].tolist(), is_word))
        whole = iter(self.runs([body[i:j] for i, j, w in cut if not w]))
        words = iter(self.plain_words([low_body[i:j] for i, j, w in cut if w]))
        apart = [next(words) if w else next(whole) for w in is_word]
        count[rest] = [len(x) // 4 for x in apart]
        begin = np.r_[0, np.cumsum(count)]
        ids = np.zeros(int(begin[-1]), np.uint32)
        for rows, first, pool in ((known, source[known], table.pool),
                                  (rest, np.cumsum(count[rest]) - count[rest], np.frombuffer(b"".join(apart), np.uint32))):
            n, to = count[rows], begin[:-1][rows]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            ids[step + np.repeat(to, n)] = pool[step + np.repeat(first, n)]
        return ids, begin[np.searchsorted(starts, offsets)]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        data, offsets = string_bytes(pa.array(texts, pa.large_string()))
        ids, begin = self.encode(data, offsets)
        return [ids[i:j].tobytes() for i, j in zip(begin[:-1].tolist(), begin[1:].tolist())]


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The text in lower case (plain runs only), starts and ends of words of
    plain runs and of all other runs as they are, and which are the former. Plain
    runs hold only what ``PLAIN`` lists, no apostrophe (it can open a word of its
    own) and no start of a special token."""
    starts, ends, _ = word_spans(data, offsets)
    n = len(data)
    before = np.r_[np.zeros(min(n, 1), np.uint8), data[:-1]]
    after = np.r_[data[1:], np.zeros(min(n, 1), np.uint8)]
    second = (before == 0xC3) & (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
    lead = (data == 0xC3) & (after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)
    ascii_ = (data >= 0x21) & (data <= 0x7E) & (data != 0x27) & ~((data == 0x3C) & (after == 0x7C))
    odd = np.r_[0, np.cumsum(~(ascii_ | second | lead))]
    run_plain = odd[ends] == odd[starts]
    upper = ((data >= 0x41) & (data <= 0x5A)) | (second & (data <= 0x9E))
    lower = data + (upper * np.uint8(32)).astype(np.uint8)
    digit = (lower >= 0x30) & (lower <= 0x39)
    letter = ((lower >= 0x61) & (lower <= 0x7A)) | second | lead
    kind = digit * np.uint8(2) + letter
    opens = digit.copy()
    opens[1:] |= kind[1:] != kind[:-1]
    edge = np.zeros(n + 1, np.int8)              # inside plain runs
    edge[starts[run_plain]] += 1
    edge[ends[run_plain]] -= 1
    opens &= np.cumsum(edge[:-1]).astype(bool)
    opens[starts] = True
    unit = np.flatnonzero(opens)
    first = np.zeros(n, bool)
    first[starts] = True
    run = np.cumsum(first[unit]) - 1
    till = ends[run]
    if len(unit):
        till[:-1] = np.minimum(till[:-1], unit[1:])
    return lower, unit, till, run_plain[run]


def _eight_bytes(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes from ``at`` on, ``size`` (up to eight) of them, as one number."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    loads = np.ndarray(len(data) + 9, "<u8", padded.data, strides=(1,))
    keep = np.clip(size, 0, 8)
    mask = np.where(keep == 8, U64(0xFFFFFFFFFFFFFFFF), (U64(1) << (U64(8) * (keep % 8).astype(np.uint64))) - U64(1))
    return loads[np.minimum(at, len(data))] & mask


class _Sorted:
    """Words by a hash, as columns. Keys are hashes, so few share their first bits:
    a row is found from where these begin."""

    COLUMNS = ("key", "low", "high", "size", "start", "count", "used")

    def __init__(self, key, *columns):
        order = np.argsort(key, kind="stable")
        for name, c in zip(self.COLUMNS, (key, *columns)):
            setattr(self, name, c[order])
        self.shift = U64(64 - max(1, len(key).bit_length()))
        self.begin = np.searchsorted((self.key >> self.shift).astype(np.int64), np.arange((1 << 64 - int(self.shift)) + 1))
        self.most = int(np.diff(self.begin).max(initial=0))

    @classmethod
    def none(cls) -> "_Sorted":
        u, i = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return cls(u, u, u, i, i, i, np.zeros(0, bool))

    def with_(self, other: "_Sorted", rows=slice(None)) -> "_Sorted":
        return _Sorted(*(np.concatenate([getattr(self, c)[rows], getattr(other, c)]) for c in self.COLUMNS))

    def row(self, key: np.ndarray) -> np.ndarray:
        """Row of each key, or of the next one after it."""
        at, last = self.begin[(key >> self.shift).astype(np.int64)], len(self.key) - 1
        behind = np.flatnonzero(self.key[np.minimum(at, last)] < key)
        for _ in range(self.most):
            if not len(behind):
                break
            at[behind] += 1
            behind = behind[self.key[np.minimum(at[behind], last)] < key[behind]]
        return np.minimum(at, last)


class WordTable:
    """Ids of words of up to 16 bytes, looked up many at once; of words that share
    a hash only one is in it. New words are kept apart until there are many, so a
    large table is sorted a few times only. When it is full, what was not looked
    for since it was last full goes."""

    def __init__(self, size: int):
        self.limit = size
        self.old, self.new = _Sorted.none(), _Sorted.none()
        self.pool, self.filled = np.zeros(1 << 16, np.uint32), 0

    def __len__(self) -> int:
        return len(self.old.key) + len(self.new.key)

    def find(self, key, low, high, size, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the ``wanted`` words are known, where their ids begin, and how many they are."""
        known = np.zeros(len(key), bool)
        start, count = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        for part in (self.old, self.new):
            todo = np.flatnonzero(wanted & ~known)
            if len(part.key) and len(todo):
                at = part.row(key[todo])
                same = ((part.key[at] == key[todo]) & (part.low[at] == low[todo]) & (part.high[at] == high[todo])
                        & (part.size[at] == size[todo]))
                at, todo = at[same], todo[same]
                part.used[at] = True
                known[todo], start[todo], count[todo] = True, part.start[at], part.count[at]
        return known, start, count

    def add(self, key, low, high, size, ids: list[bytes]) -> bool:
        """Take in words that are not in the table, each hash once; whether ids
        that were found before lie elsewhere now."""
        free = np.ones(len(key), bool)
        for part in (self.old, self.new):
            if len(part.key):
                free &= part.key[part.row(key)] != key
        if not free.any():
            return False
        ids = [x for x, ok in zip(ids, free.tolist()) if ok]
        count = np.array([len(x) // 4 for x in ids], np.int64)
        start = self.filled + np.cumsum(count) - count
        flat = np.frombuffer(b"".join(ids), np.uint32)
        while self.filled + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.filled:self.filled + len(flat)] = flat
        self.filled += len(flat)
        self.new = self.new.with_(_Sorted(key[free], low[free], high[free], size[free], start, count, np.ones(len(count), bool)))
        if len(self) > self.limit:
            self._forget()
            return True
        if len(self.new.key) > max(20_000, len(self.old.key) // 4):
            self.old, self.new = self.old.with_(self.new), _Sorted.none()
        return False

    def _forget(self) -> None:
        self.old, self.new = self.old.with_(self.new, rows=self.old.used), _Sorted.none()
        self.old.used[:] = False
        begin = np.cumsum(self.old.count) - self.old.count
        self.pool = self.pool[np.arange(int(self.old.count.sum())) + np.repeat(self.old.start - begin, self.old.count)]
        self.old.start, self.filled = begin, len(self.pool)
        self.pool = np.concatenate([self.pool, np.zeros(1 << 16, np.uint32)])


_LOADED: dict[str, WordTokenizer] = {}

SALT = "salt__"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of every whole text with the end token; only longer documents
    than ``capacity`` are cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = WordTokenizer(path)
        tok = _LOADED[path]
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            ids = column(batch, "doc_id").to_pylist()
            data, offsets = string_bytes(column(batch, "text"))
            rows = []
            for i, j in slices(offsets, SLICE_BYTES):
                off = offsets[i:j + 1]
                flat, begin = tok.encode(data[off[0]:off[-1]], off - off[0])
                body = flat.astype("<u4").tobytes()
                for d, a, b in zip(ids[i:j], (4 * begin[:-1]).tolist(), (4 * begin[1:]).tolist()):
                    enc = body[a:b] + end
                    for p, at in enumerate(range(0, len(enc), 4 * capacity)):
                        part = enc[at:at + 4 * capacity]
                        rows.append((d, p, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, items: list[int], bin_of: np.ndarray, room: np.ndarray, used: int, capacity: int) -> int:
    """Place ``items`` (longest first) into the bin with the least sufficient
    room, else a new one. ``room`` (per bin) and ``bin_of`` change in place;
    returns the number of bins."""
    shelf = sorted((int(r), b) for b, r in enumerate(room[:used].tolist()) if r > 0)
    for i in items:
        need = int(lengths[i])
        at = bisect_left(shelf, (need, -1))
        if at < len(shelf):
            r, b = shelf.pop(at)
        else:
            r, b, used = capacity, used, used + 1
        bin_of[i] = b
        room[b] = r - need
        if r > need:
            insort(shelf, (r - need, b))
    return used


def renumber(bin_of: np.ndarray) -> tuple[np.ndarray, int]:
    _, out = np.unique(bin_of, return_inverse=True)
    return out.astype(np.int64), int(out.max()) + 1 if len(out) else 0


def fitness(lengths: np.ndarray, bin_of: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (mean of squared filling)."""
    fill = np.bincount(bin_of, weights=lengths) / capacity
    return -len(fill), float((fill ** 2).mean()) if len(fill) else 0.0


def crossover(lengths: np.ndarray, a: np.ndarray, b: np.ndarray, rng, capacity: int) -> np.ndarray:
    """Child of ``a`` with some of the best-filled bins of ``b``."""
    fill = np.bincount(b, weights=lengths) / capacity
    take = (fill >= np.quantile(fill, 0.5)) & (rng.random(len(fill)) < 0.25)
    injected = take[b]
    hit = np.zeros(int(a.max()) + 1, bool)
    hit[a[injected]] = True
    displaced = hit[a] & ~injected
    child = np.where(injected, b + len(hit), a)
    child[displaced] = -1
    stay = ~displaced
    child[stay], used = renumber(child[stay])
    room = np.full(len(lengths) + 1, capacity, np.int64)
    room[:used] -= np.bincount(child[stay], weights=lengths[stay], minlength=used).astype(np.int64)
    # Items are kept longest first, so displaced ones come in that order.
    best_fit(lengths, np.flatnonzero(displaced).tolist(), child, room, used, capacity)
    return child


def refit(lengths: np.ndarray, bins: np.ndarray, share: float, rng, capacity: int) -> np.ndarray:
    """Mutation: the emptiest bins and as many others by chance, ``share`` of all
    together, are taken apart and their items placed by best fit."""
    fill = np.bincount(bins, weights=lengths)
    n = max(2, int(len(fill) * share))
    gone = np.zeros(len(fill), bool)
    gone[np.argsort(fill, kind="stable")[:n - n // 2]] = True
    gone[rng.choice(len(fill), min(n, len(fill)) // 2, replace=False)] = True
    if share >= 1:
        gone[:] = True
    loose = gone[bins]
    child = np.where(loose, -1, bins)
    child[~loose], used = renumber(child[~loose])
    room = np.full(len(lengths) + 1, capacity, np.int64)
    room[:used] -= np.bincount(child[~loose], weights=lengths[~loose], minlength=used).astype(np.int64)
    best_fit(lengths, np.flatnonzero(loose).tolist(), child, room, used, capacity)
    return child


def evolve(lengths: np.ndarray, start: list[np.ndarray], seed: int, capacity: int, population: int = POPULATION,
           generations: int = GENERATIONS, history: list | None = None) -> list[np.ndarray]:
    """Packings of ``lengths`` (falling), best first. ``start``: immigrants; the
    others begin as best fits in an order by chance. Two children a generation
    come by crossover; a generation that finds no better packing is followed by
    a mutation of the best one, of a share that grows fourfold until one is found.
    Ends at the least possible number of bins, or when all items were packed
    anew in vain. ``history`` gets the fewest bins
    after each generation."""
    rng = np.random.default_rng(seed)
    n = len(lengths)
    pool = list(start)
    floor = -(-int(lengths.sum()) // capacity)
    done = any(int(p.max(initial=-1)) + 1 <= floor for p in pool)
    while len(pool) < (len(start) if done else population):
        bins, room = np.full(n, -1, np.int64), np.full(n + 1, capacity, np.int64)
        best_fit(lengths, rng.permutation(n).tolist(), bins, room, 0, capacity)
        pool.append(bins)
    key = lambda x: fitness(lengths, x, capacity)
    pool.sort(key=key, reverse=True)
    share = 1 / 16
    for _ in range(generations):
        best = key(pool[0])
        if history is not None:
            history.append(-best[0])
        if -best[0] <= floor:   # no packing can have fewer bins
            break
        i, j = rng.choice(len(pool), 2, replace=False)
        new = [crossover(lengths, pool[i], pool[j], rng, capacity), crossover(lengths, pool[j], pool[i], rng, capacity)]
        if max(map(key, new))[0] <= best[0]:
            new.append(refit(lengths, pool[0], share, rng, capacity))
            if key(new[-1])[0] > best[0]:
                share = 1 / 16
            elif share < 1:
                share *= 4
            else:
                break       # not even a packing of all items anew is better
        pool = sorted([*pool, *new], key=key, reverse=True)[:population]
    return pool


def _ordered(items: pd.DataFrame) -> pd.DataFrame:
    return items.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True],
                             kind="stable", ignore_index=True)


def pack_pieces(pieces: DataFrame, n_regions: int, capacity: int = CAPACITY, islands: int = ISLANDS,
                epochs: int = EPOCHS) -> DataFrame:
    """``pieces`` plus sequence_id and offset."""
    # Rows with the same or no doc_id are dealt out too: the salt counts rows.
    salted = pieces if SALT in pieces.columns else pieces.withColumn(SALT, F.monotonically_increasing_id()).checkpoint()
    region = F.pmod(F.xxhash64("doc_id", "piece", SALT), F.lit(n_regions)).cast("int")
    items = salted.withColumn("region", region).drop(SALT)
    short = items.where(F.col("length") < capacity).select("region", "doc_id", "piece", "ids_crc32", "length")
    dealt = short.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    kinds = "region int, island int, packing binary, bins long, filling double"

    def answer(r: int, i: int, lengths: np.ndarray, best: np.ndarray) -> pd.DataFrame:
        bins, filling = fitness(lengths, best, capacity)
        return pd.DataFrame({"region": [r], "island": [i], "packing": [best.astype("<i4").tobytes()],
                             "bins": [-bins], "filling": [filling]})

    def first(key, pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = _ordered(pdf)["length"].to_numpy(np.int64)
        r, i = int(key[0]), int(key[1])
        return answer(r, i, lengths, evolve(lengths, [], r * 31 + i, capacity)[0])

    def later(key, pdf: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return answer(int(key[0]), int(key[1]), np.zeros(0, np.int64), np.zeros(0, np.int64)).iloc[:0]
        lengths = _ordered(pdf)["length"].to_numpy(np.int64)
        guests = [np.frombuffer(p, "<i4").astype(np.int64) for p in elites["packing"]]
        r, i = int(key[0]), int(key[1])
        return answer(r, i, lengths, evolve(lengths, guests, r * 31 + i + 7919, capacity)[0])

    elites = dealt.groupBy("region", "island").applyInPandas(first, kinds)
    for _ in range(epochs - 1):
        # Each elite is seen by its own island and by the next one.
        moved = elites.select("region", F.explode(F.array(
            F.col("island"), F.pmod(F.col("island") + 1, F.lit(islands)))).alias("island"), "packing")
        elites = dealt.groupBy("region", "island").cogroup(moved.groupBy("region", "island")).applyInPandas(later, kinds)
    best = elites.groupBy("region").agg(
        F.max_by("packing", F.struct(-F.col("bins"), F.col("filling"), -F.col("island"))).alias("packing"))

    out_kinds = PIECES + ", sequence_id long, offset long"

    def settle(key, pdf: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        pdf = _ordered(pdf)
        full = (pdf["length"] >= capacity).to_numpy()
        bins = np.empty(len(pdf), np.int64)
        n = 0
        if len(chosen):
            bins[~full] = np.frombuffer(chosen["packing"].iloc[0], "<i4")
            n = int(bins[~full].max()) + 1
        bins[full] = n + np.arange(int(full.sum()))
        pdf["sequence_id"] = int(key[0]) * (1 << 32) + bins
        order = np.argsort(bins, kind="stable")
        length = pdf["length"].to_numpy(np.int64)[order]
        before = np.cumsum(length) - length
        opened = np.r_[True, bins[order][1:] != bins[order][:-1]] if len(order) else np.zeros(0, bool)
        base = np.maximum.accumulate(np.where(opened, before, 0))
        offset = np.empty(len(pdf), np.int64)
        offset[order] = before - base
        pdf["offset"] = offset
        return pdf[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return items.groupBy("region").cogroup(best.groupBy("region")).applyInPandas(settle, out_kinds)


def pack_documents(spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """PIECES columns with sequence_id and offset for every document."""
    ensure_checkpoint_dir(spark)
    # A few dozen bytes a piece; the texts are tokenised once.
    pieces = cut_pieces(docs, path, capacity).withColumn(SALT, F.monotonically_increasing_id()).checkpoint()
    n = pieces.count()
    return pack_pieces(pieces, max(1, -(-n // REGION_ITEMS)), capacity)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    import public_tokenizers
    return pack_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          public_tokenizers.path("word_bpe_49k.json"))
