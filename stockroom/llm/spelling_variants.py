"""Spelling variants: words one edit apart, by a frequency-vector trie.

A word's vector counts its code points in ``GROUPS`` groups (code point modulo
the number of groups). One edit of a code point raises one count by one, lowers
one count by one, or does both. The trie arranges words by these counts, one
group a level. A vector is looked up by a depth-first search that follows the
equal count everywhere and spends, once each, a surplus (one more in the other
word) and a deficit (one less). The surplus has to come first, so that of two
words only one finds the other: the shorter one, or the one with more of the
later group; of words with one vector the smaller one counts. Words at the leaves
that are reached are verified, many pairs at once.

The top of the trie is searched over prefixes of vectors, which are far fewer than
words: a unit of work is a prefix whose words ask, a node (a prefix of the same
depth) whose words answer, and what is left of the budget. Units go down to the
next depth while the node has more than ``LIMIT`` words or is asked by more than
``VISITS``; below that, a task holds the node's words as a trie and lets the asking
words pass. Nodes that are still too large at full depth (many words of one
vector) are solved by deletions instead: two words one edit apart share the longer
one less one code point, and at most one group of these meets at a word and a place.

Forms are chosen from each word's best near word; roots are found by pointer
doubling over the forms, whose counts at least double, so it ends after a few
joins whatever the size.

Defined results: null texts have no words; a null doc_id is written as an empty
string in the key of the planted deletions; ties between forms go to the word
that comes first in code-point order; repeated rows count again; other columns
are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockroom.llm.textbytes import column
from stockroom.session import ensure_checkpoint_dir

PLANTED = 97
MIN_LENGTH, MIN_COUNT = 5, 3
#: Runs that can become a word, after A-Z are put in lower case. (A shorter run
#: has no match, so a match is a whole run.)
RUN = re.compile("[a-z\\u00C0-\\u00FF]{%d,}" % MIN_LENGTH)
LETTERS = re.compile("[a-z\\u00C0-\\u00FF]+")
GROUPS = 16
#: Depths of the trie at which units of work may stop.
DEPTHS = (4, 6, 8, 12, 16)
LIMIT, VISITS = 8192, 1 << 17
#: Pairs verified at once, and code points of words that are compared as arrays.
PAIRS, WIDTH = 1 << 17, 48
#: Different words a task holds before it passes their counts on.
HELD = 100_000
#: Key of the words at the end of a path through the trie.
LEAF = "words"
#: Characters of a text that are looked at in one step.
STEP = 1 << 20


# ---------------------------------------------------------------- words

def _pieces(text: str) -> Iterator[str]:
    """A text in steps that cut no run."""
    at = 0
    while at < len(text):
        end = at + STEP
        if end < len(text):
            open_run = LETTERS.match(text, end)
            if open_run:
                end = open_run.end()
        yield text[at:end]
        at = end


def text_words(doc_id, text: str) -> Counter:
    """Words of a text with their counts, planted deletions made."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    runs: Counter = Counter()
    out: Counter = Counter()
    for piece in _pieces(text.encode().lower().decode()):
        runs.update(RUN.findall(piece))
        if len(runs) > HELD:
            _plant(seed, runs, out)
            runs = Counter()
    _plant(seed, runs, out)
    return out


def _plant(seed: int, runs: Counter, out: Counter) -> None:
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), seed)
        if h % PLANTED == 0:
            i = h % len(run)
            run = run[:i] + run[i + 1:]
            if len(run) < MIN_LENGTH:
                continue
        out[run] += n


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n: counts of a task, passed on whenever it holds many words."""
    held: Counter = Counter()

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          names=["word", "n"])

    for batch in batches:
        ids, texts = column(batch, "doc_id"), column(batch, "text")
        for i in range(len(batch)):
            text = texts[i].as_py()
            if text:
                held.update(text_words(ids[i].as_py(), text))
                if len(held) > HELD:
                    yield flush()
                    held.clear()
    if held:
        yield flush()


def _with_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = column(batch, "word")
        yield pa.RecordBatch.from_arrays(
            [words, column(batch, "n"), pa.array([vector(w) for w in words.to_pylist()], pa.binary())], names=["word", "n", "vec"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n, vec of every word that is long and frequent enough."""
    return (docs.select("doc_id", "text").mapInArrow(_counts, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
            .mapInArrow(_with_vectors, "word string, n long, vec binary"))


# ---------------------------------------------------------------- vectors and the trie

def vector(word: str) -> bytes:
    """Count of each group; counts over 255 are one value, which only lets more
    words through to the verification."""
    out = [0] * GROUPS
    for c in word:
        out[ord(c) % GROUPS] += 1
    return bytes(min(x, 255) for x in out)


def near(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if n == len(b) else a[i:] == b[i + 1:]


def reach(counts: bytes, surplus: int, deficit: int) -> list[tuple[bytes, int, int]]:
    """Counts of other words within the budget, and what is left of it; a
    deficit is spent after the surplus only."""
    out = [(counts, surplus, deficit)]
    up = ([(i, counts[:i] + bytes([c + 1]) + counts[i + 1:]) for i, c in enumerate(counts) if c < 255] if surplus
          else [(-1, counts)])
    if surplus:
        out += [(x, 0, deficit) for _, x in up]
    if deficit:
        out += [(x[:j] + bytes([x[j] - 1]) + x[j + 1:], 0, 0) for i, x in up for j in range(i + 1, len(x)) if x[j]
                if not surplus or i >= 0]
    return out


class Trie:
    """Ranges of a node's words, which are sorted by vector, by the counts below it."""

    def __init__(self, depth: int, vectors: list[bytes]):
        self.depth, self.root = depth, {}
        begin = 0
        for i in range(1, len(vectors) + 1):
            if i == len(vectors) or vectors[i] != vectors[begin]:
                node = self.root
                for c in vectors[begin][depth:]:
                    node = node.setdefault(c, {})
                node[LEAF] = (begin, i)
                begin = i

    def search(self, v: bytes, surplus: int, deficit: int) -> list[tuple[int, int]]:
        """Ranges of the words that the budget reaches, depth first."""
        out, stack = [], [(self.depth, self.root, surplus, deficit)]
        while stack:
            level, node, s, d = stack.pop()
            if level == GROUPS:
                out.append(node[LEAF])
                continue
            c = v[level]
            if c in node:
                stack.append((level + 1, node[c], s, d))
            if s and c + 1 in node:
                stack.append((level + 1, node[c + 1], 0, d))
            elif d and not s and c - 1 in node:
                stack.append((level + 1, node[c - 1], 0, 0))
        return out


# ---------------------------------------------------------------- units of work

UNIT = "asks binary, node binary, surplus int, deficit int"
_UNIT = pa.schema([("asks", pa.binary()), ("node", pa.binary()), ("surplus", pa.int32()), ("deficit", pa.int32())])


def _descend(depth: int):
    """asks (a prefix of any depth), node and budget at ``depth`` -> the nodes
    reached at the depth of ``asks``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(asks, node + x, s, d) for asks, node, surplus, deficit in zip(*(column(batch, f.name).to_pylist() for f in _UNIT))
                    for x, s, d in reach(asks[depth:], surplus, deficit)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _UNIT)], schema=_UNIT)

    return run


def units(vocab: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Units of work small enough for a task, with their depth, and those of the
    last depth that are not."""
    prefix = lambda d: F.substring("vec", 1, d)
    done, before, depth = None, None, 0
    for d in DEPTHS:
        nodes = vocab.groupBy(prefix(d).alias("prefix")).agg(F.count("*").alias("words"))
        if before is None:
            asking = nodes.select(F.col("prefix").alias("asks"), F.lit(b"").alias("node"),
                                  F.lit(1).alias("surplus"), F.lit(1).alias("deficit"))
        else:
            asking = (nodes.select(F.substring("prefix", 1, depth).alias("asks"), "prefix").join(before, "asks")
                      .select(F.col("prefix").alias("asks"), "node", "surplus", "deficit"))
        found = (asking.mapInArrow(_descend(depth), UNIT)
                 .join(nodes.select(F.col("prefix").alias("node"), "words"), "node")
                 .join(nodes.select(F.col("prefix").alias("asks"), F.col("words").alias("asking")), "asks").checkpoint())
        load = found.groupBy("node").agg(F.sum("asking").alias("visits"))
        found = found.join(load, "node").checkpoint()
        few = (F.col("words") <= LIMIT) & (F.col("visits") <= VISITS)
        small = found.where(few).select(F.lit(d).alias("depth"), "asks", "node", "surplus", "deficit")
        done = small if done is None else done.unionByName(small)
        before, depth = found.where(~few).select("asks", "node", "surplus", "deficit"), d
        if before.isEmpty():
            return done, None
    return done, before


# ---------------------------------------------------------------- search in nodes

ENTRY, QUERY = 0, 1
BEST = "word string, n_near long, form_n long, form string"


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """First WIDTH code points (all below 256) and lengths."""
    out = np.array([w[:WIDTH].encode("latin-1") for w in words], f"S{WIDTH + 1}")
    return out.view(np.uint8).reshape(len(words), WIDTH + 1), np.array([len(w) for w in words], np.int64)


def _verified(a: np.ndarray, b: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Which pairs of rows differ by one replaced code point or, where ``b`` is
    longer by one, by one inserted one."""
    out = (a != b).sum(axis=1) == 1
    at = np.flatnonzero(longer)
    if len(at):
        a, b = a[at], b[at]
        same_to = np.argmin(a == b, axis=1)          # the longer word ends later, so they differ somewhere
        shifted = a[:, :-1] != b[:, 1:]
        last = shifted.shape[1] - 1 - np.argmax(shifted[:, ::-1], axis=1)
        out[at] = ~shifted.any(axis=1) | (last < same_to)
    return out


class Node:
    """The words of a node, and the pairs that asking words make with them."""

    def __init__(self, depth: int, rows: list[tuple[bytes, str, int]]):
        rows.sort()
        self.vecs, self.words = [r[0] for r in rows], [r[1] for r in rows]
        self.n = np.array([r[2] for r in rows], np.int64)
        self.codes, self.length = _codes(self.words)
        self.trie = Trie(depth, self.vecs)

    def pairs(self, asks: list[tuple[bytes, int, int, str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indexes of asking words and of the node's words that are near."""
        by: dict = {}
        for i, (v, s, d, _) in enumerate(asks):
            by.setdefault((v, s, d), []).append(i)
        who, lo, hi = [], [], []
        for (v, s, d), mine in by.items():
            for begin, end in self.trie.search(v, s, d):
                who += mine
                lo += [begin] * len(mine)
                hi += [end] * len(mine)
        if not who:
            return
        who, lo, hi = (np.array(x, np.int64) for x in (who, lo, hi))
        words = [r[3] for r in asks]
        codes, length = _codes(words)
        till = np.cumsum(hi - lo)
        i = 0
        while i < len(who):
            j = max(i + 1, int(np.searchsorted(till, (till[i - 1] if i else 0) + PAIRS, "right")))
            size = hi[i:j] - lo[i:j]
            a = np.repeat(who[i:j], size)
            b = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo[i:j], size)
            i = j
            la, lb = length[a], self.length[b]
            short = (la < WIDTH) & (lb < WIDTH)
            near_pairs = np.zeros(len(a), bool)
            k = np.flatnonzero(short)
            near_pairs[k] = _verified(codes[a[k]], self.codes[b[k]], lb[k] > la[k])
            for x in np.flatnonzero(~short).tolist():
                near_pairs[x] = near(words[a[x]], self.words[b[x]])
            a, b = a[near_pairs], b[near_pairs]
            # Words of one vector find each other from both sides.
            once = [asks[x][0] != self.vecs[y] or words[x] < self.words[y] for x, y in zip(a.tolist(), b.tolist())]
            yield a[once], b[once]


def _best(words: list[str], others: list[str], counts: list[int]) -> Iterator[tuple]:
    """word, near words, count and word of the best one."""
    seen: dict[str, list] = {}
    for w, o, n in zip(words, others, counts):
        got = seen.get(w)
        if got is None:
            seen[w] = [1, n, o]
        else:
            got[0] += 1
            if n > got[1] or n == got[1] and o < got[2]:
                got[1:] = n, o
    return ((w, *x) for w, x in seen.items())


WORK = "depth int, node binary, kind int, word string, n long, vec binary, surplus int, deficit int"


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node, its own words first -> near words of both sides."""
    cols = [c.split()[0] for c in WORK.split(", ")]
    now, own, node, asks = None, [], None, []

    def answers():
        words, others, counts = [], [], []
        for a, b in node.pairs([(r[0], r[1], r[2], r[3]) for r in asks]):
            left, right = [asks[x][3] for x in a.tolist()], [node.words[y] for y in b.tolist()]
            words += left + right
            others += right + left
            counts += node.n[b].tolist() + [asks[x][4] for x in a.tolist()]
        rows = list(_best(words, others, counts))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["word", "n_near", "form_n", "form"])

    for batch in batches:
        for depth, key, kind, word, n, vec, s, d in zip(*(column(batch, c).to_pylist() for c in cols)):
            if (depth, key) != now:
                if asks:
                    yield from answers()
                now, own, node, asks = (depth, key), [], None, []
            if kind == ENTRY:
                own.append((vec, word, n))
                continue
            if node is None:
                node, own = Node(depth, own), []
            asks.append((vec, s, d, word, n))
            if len(asks) >= 8192:
                yield from answers()
                asks = []
    if asks:
        yield from answers()


def _deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, shape, place, kind, word, n: digest of what a word leaves without
    each of its code points, and of itself. Two words of a length meet where both
    lack the same place; a word meets a longer one where that is left as the word."""
    digest = lambda x: xxhash.xxh3_128_digest(x.encode())
    out, size = [], 0
    for batch in batches:
        for node, kind, word, n in zip(*(column(batch, c).to_pylist() for c in ("node", "kind", "word", "n"))):
            out.append((node, digest(word), -1, kind, word, n, False))
            for i in range(len(word)):
                rest = digest(word[:i] + word[i + 1:])
                out.append((node, rest, i, kind, word, n, True))
                if i == 0 or word[i] != word[i - 1]:       # once for a run of one letter
                    out.append((node, rest, -1, kind, word, n, True))
                size += len(word) + 50
                if size > 1 << 22:
                    yield _shapes(out)
                    out, size = [], 0
    if out:
        yield _shapes(out)


SHAPES = "node binary, shape binary, place int, kind int, word string, n long, less boolean"


def _shapes(rows: list) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=[x.split()[0] for x in SHAPES.split(", ")])


def by_deletions(vocab: DataFrame, crowded: DataFrame) -> DataFrame:
    """Near words across units at full depth of any size. Where both words lack
    the same place they differ there alone; at place -1 one of them is whole, so
    it is the other less a code point."""
    asking = crowded.join(vocab.withColumnRenamed("vec", "asks"), "asks").select("node", F.lit(QUERY).alias("kind"), "word", "n")
    own = crowded.select("node").distinct().join(vocab.withColumnRenamed("vec", "node"), "node").select(
        "node", F.lit(ENTRY).alias("kind"), "word", "n")
    shapes = asking.unionByName(own).mapInArrow(_deletions, SHAPES)
    left = shapes.where(F.col("kind") == QUERY).select("node", "shape", "place", F.col("word").alias("a"), F.col("n").alias("a_n"), "less")
    right = shapes.where(F.col("kind") == ENTRY).select("node", "shape", "place", F.col("word").alias("b"), F.col("n").alias("b_n"),
                                                        F.col("less").alias("other_less"))
    pairs = (left.join(right, ["node", "shape", "place"]).where("a <> b and (place >= 0 or less <> other_less)")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                     F.when(F.col("a") < F.col("b"), F.col("a_n")).otherwise(F.col("b_n")).alias("a_n"),
                     F.when(F.col("a") < F.col("b"), F.col("b_n")).otherwise(F.col("a_n")).alias("b_n")).distinct())
    directed = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))).alias("p")).select("p.*")
    return directed.groupBy("word").agg(F.count("*").alias("n_near"), F.max("other_n").alias("form_n"),
                                        F.min(F.struct(-F.col("other_n"), "other"))["other"].alias("form"))


def near_words(vocab: DataFrame) -> DataFrame:
    """word, n_near, form_n, form: near words of each word that has one, and the
    most frequent of them."""
    small, crowded = units(vocab)
    prefixed = vocab.withColumn("depth", F.explode(F.array(*map(F.lit, DEPTHS)))).withColumn(
        "prefix", F.expr("substring(vec, 1, depth)"))
    asking = small.withColumnRenamed("asks", "prefix").join(prefixed, ["depth", "prefix"]).withColumn("kind", F.lit(QUERY))
    own = small.select("depth", F.col("node").alias("prefix")).distinct().join(prefixed, ["depth", "prefix"]).withColumn(
        "node", F.col("prefix")).withColumns({"kind": F.lit(ENTRY), "surplus": F.lit(0), "deficit": F.lit(0)})
    cols = [c.split()[0] for c in WORK.split(", ")]
    found = (asking.select(*cols).unionByName(own.select(*cols)).repartition("depth", "node")
             .sortWithinPartitions("depth", "node", "kind").mapInArrow(_searched, BEST))
    if crowded is not None:
        found = found.unionByName(by_deletions(vocab, crowded))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.max("form_n").alias("form_n"),
                                     F.min(F.struct(-F.col("form_n"), "form"))["form"].alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root from (word, form): forms followed to the last, in doubling steps."""
    at = forms.select("word", F.coalesce("form", "word").alias("root"), F.col("form").isNull().alias("done")).checkpoint()
    while not at.where("not done").isEmpty():
        step = at.select(F.col("word").alias("w"), F.col("root").alias("r"), F.col("done").alias("d"))
        moved = (at.where("not done").join(step, F.col("root") == F.col("w"))
                 .select("word", F.col("r").alias("root"), F.col("d").alias("done")))
        at = at.where("done").unionByName(moved).checkpoint()
    return at.select("word", "root")


def spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``."""
    ensure_checkpoint_dir(spark)
    vocab = vocabulary(docs).checkpoint()
    better = F.col("form_n") >= 2 * F.col("n")
    forms = (vocab.join(near_words(vocab), "word", "left")
             .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                     F.when(better, F.col("form")).alias("form"), F.when(better, F.col("form_n")).alias("form_n")).checkpoint())
    return forms.join(roots(forms.select("word", "form")), "word").select("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of all words of the documents."""
    return spelling_variants(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
