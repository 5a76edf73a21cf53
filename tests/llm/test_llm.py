"""Operators of the llm subpackage against brute force on small tables that
hold nulls, empty and long texts, ties, repeated rows and extra columns."""

import collections
import hashlib
import json
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from stockroom.llm import (bpe, chosen_path, html_extract, packing, quality_fm, quality_rules, sharding,  # noqa: E402
                           substring_dedup, suffix_dedup, topk)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, marks string, bucket int"


def _texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = say(60), say(120)
    out = [None, "", " \n\t ", "one two", say(4), say(12), say(13), base, base, base + " " + say(3),
           say(40) + "\n" + passage + "\n" + say(30), say(20) + " " + passage + " " + say(5), passage,
           "x " * 900, say(3000), "### a $$$ |||", "a\x00b c <|endoftext|> d", "\U0001F642" * 80]
    for _ in range(12):   # near copies
        w = base.split()
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def texts():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, "s", 0, "m", 1) for i, t in enumerate(texts)]
    rows.append(rows[7])          # repeated row
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_bpe_equals_the_library(docs, empty, texts):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    enc = bpe.encode_documents(docs, path)
    got = {r.doc_id: r.ids for r in enc.collect()}
    back = {r.doc_id: r.text for r in bpe.decode_documents(enc, path).collect()}
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i] == ids
        assert back[i] == lib.decode(ids, skip_special_tokens=False) == (t or "")
    assert bpe.token_digests(empty, path).count() == 0


def test_bpe_verification_finds_every_wrong_proposal():
    b = bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    words = ["".join(rng.choice("thereonandi ") for _ in range(rng.randint(1, 14))).encode() for _ in range(3000)]
    assert b.encode_words(words) == [b._merge(w) for w in words]


def test_bpe_long_words():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, b = Tokenizer.from_file(path), bpe.ByteBpe(path)
    rng = random.Random(9)
    texts = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("a", "ab", "thereonandi", "éß漢", "#$", "0123")
             for n in (255, 256, 257, 5000, 60_000)]
    for t, got in zip(texts, b.encode_batch(texts)):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids
    words = ["".join(rng.choice("thereonandi") for _ in range(rng.randint(1, 40))).encode() for _ in range(2000)]
    assert [b._merge_long(w) for w in words] == [b._merge(w) for w in words]


def test_memo_forgets_long_keys_sooner():
    from stockroom.llm.textbytes import Memo
    for size in (4, 6400):
        memo, asked = Memo(100), 0
        for i in range(1000):
            new = memo.missing({f"{i:0{size}d}", "always"})
            asked += "always" in new
            memo.now.update(dict.fromkeys(new, 0))
            assert memo.weight([*memo.now, *memo.before]) <= 2 * max(100, Memo.weight(new) + 1)
        assert asked == 1     # what is used stays


def _suffix_brute(bodies):
    count = collections.Counter(b[i:i + 200] for b in bodies for i in range(len(b) - 199))
    out = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i:i + 200] = [True] * 200
        out.append(gone)
    return out


def test_suffix_dedup(spark, docs, empty, texts):
    bodies = [(t or "").encode() for t in texts] + [(texts[7]).encode()]
    want = _suffix_brute(bodies)
    got = {r.doc_id: r for r in suffix_dedup.repeated_strings(docs).mapInArrow(
        suffix_dedup._digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").collect()}
    for i, gone in enumerate(want[:-1]):
        kept = bytes(c for c, g in zip(bodies[i], gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(gone), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert suffix_dedup.repeated_strings(empty).count() == 0


@pytest.mark.parametrize("letters", ["ab", "a", "abcz\x00\xff"])
def test_two_stage_suffix_array(letters):
    rng = random.Random(len(letters))
    text = np.frombuffer("".join(rng.choice(letters) for _ in range(400)).encode("latin-1"), np.uint8)
    wanted = np.zeros(400, bool)
    wanted[:370] = True
    order = suffix_dedup.suffix_array(text, wanted, 24)
    body = text.tobytes() + bytes(40)
    keys = [body[i:i + 24] for i in order]
    assert sorted(order.tolist()) == list(range(370))
    assert keys == sorted(keys)


def test_hot_anchor_is_split(docs, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", 1)
    bodies = [(t or "").encode() for t in texts] + [texts[7].encode()]
    want = [sum(g) for g in _suffix_brute(bodies)][:-1]
    rows = suffix_dedup.repeated_strings(docs).collect()
    got = {}
    for r in rows:
        gone, _ = suffix_dedup.removed_spans(len((r.text or "").encode()), [m for m in (r.marks, r.more) if m])
        got[r.doc_id] = 0 if gone is None else int(gone.sum())
    assert [got[i] for i in range(len(want))] == want


def test_substring_dedup(docs, empty, texts):
    words = [(t or "").encode().split() for t in texts]
    first = {}
    for d, w in enumerate(words):
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i:i + 13]), d)
    got = {r.doc_id: r for r in substring_dedup.window_digests(docs).collect()}
    kept_docs = {r.doc_id: r for r in substring_dedup.kept_documents(docs).collect()}
    for d, w in enumerate(words):
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < d:
                gone[i:i + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
        assert kept_docs[d].text == (kept.decode() if any(gone) else texts[d])
        assert kept_docs[d].source == "s"
    assert substring_dedup.window_digests(empty).count() == 0


def test_quality_rules_counts_and_tail(spark, docs, empty, texts):
    got = {r.doc_id: r for r in quality_rules.text_metrics(docs, ["doc_id"]).collect()}
    for d, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        tri = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
    cases = [(1000, 0, 0.01), (1000, 4, 0.01), (5000, 30, 0.01), (200_000, 1100, 0.006)]
    df = spark.createDataFrame(cases, "n long, k long, p double")
    for n, k, p in cases:
        tail = df.where((F.col("n") == n) & (F.col("k") == k)).select(
            quality_rules.binomial_tail(F.col("n"), F.col("k"), p)).first()[0]
        exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
                             + (n - i) * math.log1p(-p)) for i in range(k + 1))
        assert tail == pytest.approx(exact, rel=1e-6)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.score_documents(spark, empty, labels).count() == 0
    out = quality_rules.score_documents(spark, docs, labels)
    assert out.where(F.col("kept") == F.col("base_failed")).count() == 0   # no labels: base rules only


def test_certified_cutoffs_bound_false_rejection(spark):
    good = spark.range(6000).select(F.lit("en").alias("stratum"), F.lit(1).alias("quality"), F.lit(False).alias("base_failed"),
                                    F.lit(100).alias("n_words"), F.lit(500).alias("word_chars"),
                                    F.when(F.col("id") < 30, 50).otherwise(0).alias("n_symbols"),
                                    F.lit(0).alias("n_dup_lines"), F.lit(5).alias("n_lines"), F.lit(0).alias("n_repeat_words"))
    cut = quality_rules.cutoffs(good).first()
    assert cut["symbols"] == 0.6          # 30 of 6000 at 0.5: not surely below 0.6 %
    assert cut["repeats"] == 0.02
    assert quality_rules.cutoffs(good.limit(50)).count() == 0   # too few labels: rules stay off


def test_classifier(spark, docs, empty):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        w = ["".join(rng.choice("aeiou") for _ in range(5)) + ("%%%" if bad else "") for _ in range(60)]
        rows.append((i, " ".join(w), "en", "s", 0, "m", 1))
        labels.append((i, 0 if bad else 1, 0))
    table = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_fm.classify(table, marks).collect()}
    held = [r for r in got.values() if r.held_out]
    assert held and all(r.predicted == (r.doc_id % 4 != 0) for r in held)
    scores = quality_fm.classify(docs, marks.limit(0)).collect()
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert quality_fm.classify(empty, marks).count() == 0


def test_pair_sum_identity():
    fm = quality_fm.FactorMachine()
    o, i, x = np.zeros(5, int), np.array([1, 2, 3, 40_000 % (1 << 15), 7]), np.arange(1, 6).astype(np.float32)
    z, _, _ = fm.raw(o, i, x, 1)
    pairs = sum(float(fm.v[i[a]] @ fm.v[i[b]]) * x[a] * x[b] for a in range(5) for b in range(a))
    assert z[0] == pytest.approx(pairs, abs=1e-5)


def test_packing(spark, docs, empty, texts):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    got = packing.pack_documents(spark, docs, path, capacity=256).collect()
    per = collections.Counter()
    for r in got:
        per[r.doc_id] += r.length
    for d, t in enumerate(texts):
        n = len(lib.encode(t or "", add_special_tokens=False).ids) + 1
        assert per[d] == n * (2 if d == 7 else 1)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 256
    assert len(bins) <= -(-sum(r.length for r in got) // 256) + 1
    assert packing.pack_documents(spark, empty, path).count() == 0


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(2)
    lengths = -np.sort(-rng.integers(1, 1000, 500))
    pool = packing.evolve(lengths, [], 1, 1024, generations=0)
    child = packing.crossover(lengths, pool[0], pool[1], rng, 1024)
    assert (child >= 0).all() and np.bincount(child, weights=lengths).max() <= 1024


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies, really.</div>
<div id="story"><h1>Big &amp; <i>new</i></h1><p>First part, with some words in it. And more
 of them.<p>Second part; also long enough, it seems.<br>Same block.<p>Ok.</div>
<div class="comments"><p>Great text, I liked it very much, thank you!</p></div><form><p>Your name, please.</p></form>
<script>var x = "<p>no</p>";</script><footer>&copy; somebody, 2020.</footer>"""


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 3), (2, None, None, 3), (3, "u", "", 3), (4, "u", "<p>a<", 3), (1, "u", PAGE, 3)],
                                  "page_id long, url string, html string, text int")
    got = sorted(map(tuple, html_extract.extract(pages).fillna("", ["url"]).collect()))
    text = "Big & new\nFirst part, with some words in it. And more of them.\nSecond part; also long enough, it seems. Same block.\nOk."
    assert [g[2] for g in got if g[0] == 1] == [text, text]
    assert [g[2:] for g in got if g[0] in (2, 3)] == [("", 0), ("", 0)]
    assert html_extract.extract(pages.limit(0)).count() == 0
    assert html_extract.main_text("<article><h1>T</h1><p>One.</p><div class='ad'>Buy, now, cheap!</div></article><footer>Long "
                                  "footer, with, many, marks. " + "And text. " * 20 + "</footer>") == "T\nOne."


@pytest.mark.parametrize("page, text", [
    ('<p>One two, three.</p><p title="the hidden gem">See <a href="/hidden-gems">it</a> now.</p>', "One two, three.\nSee it now."),
    ('<p data-hidden="false">One, two.</p><p aria-hidden="true">Icon, only.</p><p hidden>Not this.</p>', "One, two."),
    ("<html><head><title>T</title><body><p>No end of the head, here.", "No end of the head, here."),
    ("<svg/><p>After a closed element, text.", "After a closed element, text."),
    ("<p title='a > b' data-x=it's>One, two.</p><p clas", "One, two."),
])
def test_html_attributes_and_unclosed_tags(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("part", ['"', "<a", '="', '<a b="', "<!", "<div>", '<div class="a b">', "<div></i2>", "</", "<svg "])
def test_html_is_linear_on_broken_markup(part):
    page = "<p>Some text, here.</p><p " + part * 40_000
    found = html_extract.blocks(page)
    assert found and found[0].text == "Some text, here."
    assert html_extract.blocks("<div>" * 20_000 + "deep" + "</i2>" * 20_000)[0].text == "deep"


def test_html_scores_decide_beside_an_article():
    body = [f"Part {i} of the story, with enough words to be told; and a second clause, too." for i in range(6)]
    story = '<div id="story">' + "".join(f"<p>{b}</p>" for b in body) + "</div>"
    links = "<ul>" + '<li><a href="/x">More of this</a></li>' * 4 + "</ul>"
    got = html_extract.main_text(story + "<article><p>Teaser.</p></article>" + links)
    assert got == "\n".join(body) + "\nTeaser."


@pytest.mark.parametrize("page, text", [
    ('<div><span class="skip">Skip</span><p>One, two.</p><p>Three, four.</p></div>', "One, two.\nThree, four."),
    ('<article><span class="share">Share</span><p>One, two.</p></article>', "One, two."),
    ('<p>One, two <span class="hidden">x</span> and the rest.</p><p>Next, too.</p>', "One, two\nand the rest.\nNext, too."),
    ('<p>One, two <small hidden>a <small>b</small> c</small> and the rest.</p>', "One, two\nand the rest."),
    ('<p>One, two <time style="display:none">x<b>y</b></p><p>Next, too.</time></p>', "One, two\nNext, too."),
])
def test_html_marked_inline_elements_end(page, text):
    assert html_extract.main_text(page) == text


STORY = "<h1>Head</h1>" + "".join(f"<p>Part {i} of it, told in enough words; and a second clause, too.</p>" for i in range(4))
TOLD = "\n".join(["Head"] + [f"Part {i} of it, told in enough words; and a second clause, too." for i in range(4)])


@pytest.mark.parametrize("page", [
    f'<main class="content with-sidebar">{STORY}</main>',
    f'<article class="post no-comments">{STORY}</article>',
    f'<article class="post share-social">{STORY}</article>',
    f'<div id="page" class="has-footer"><article>{STORY}</article></div>',
    f'<div class="layout-sidebar-left"><main>{STORY}</main></div>',
    f'<div class="layout-sidebar-left"><article>{STORY}</article><div class="comments"><article class="comment">'
    f'<p>Well said.</p></article></div></div>',
    f'<div class="sidebar-layout"><article>{STORY}</article></div><div class="comments">' + "<p>I say, me too.</p>" * 40 + "</div>",
])
def test_html_words_of_class_and_id_do_not_empty_a_page(page):
    assert html_extract.main_text(page) == TOLD


def test_html_words_are_a_penalty():
    assert html_extract.main_text('<p class="related">A single paragraph, of many words.</p>') == "A single paragraph, of many words."
    text = "This goes on, at length; it is told in full, with all there is to tell, and more. " * 9
    page = f'<div class="layout-sidebar-left"><p>{text}</p></div><p>Short, that.</p><article><p>Teaser.</p></article>'
    assert text.strip() in html_extract.main_text(page)


def test_near_duplicates(spark, docs, empty, texts):
    sets = []
    for t in texts:
        w = (t or "").encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    rep = {}
    for d, t in enumerate(texts):
        rep.setdefault(t or "", d)
    reps = sorted(rep.values())
    links, parent = collections.Counter(), list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in reps:
        for b in reps:
            if a < b and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    got = {r.doc_id: r for r in chosen_path.near_duplicates(spark, docs).collect()}
    for d, t in enumerate(texts):
        r = rep[t or ""]
        assert (got[d].class_id, got[d].n_links) == (find(r), links[r])
    assert chosen_path.near_duplicates(spark, empty).count() == 0


def test_large_buckets_are_compared_in_blocks(spark, docs, monkeypatch):
    want = sorted(map(tuple, chosen_path.near_duplicates(spark, docs).collect()))
    monkeypatch.setattr(chosen_path, "BRUTE", 2)
    monkeypatch.setattr(chosen_path, "BLOCK", 4)
    monkeypatch.setattr(chosen_path, "LEVELS", 1)
    assert sorted(map(tuple, chosen_path.near_duplicates(spark, docs).collect())) == want


def test_crowded_buckets_lose_no_pair(spark, monkeypatch):
    """Pairs just above 0.8 whose buckets are split down to the last level."""
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[:4 + i] + ["changed"] + words[5 + i:])) for i in range(90)]
    monkeypatch.setattr(chosen_path, "BRUTE", 2)
    got = chosen_path.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 89)}


def test_topk(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(400)]
    rows += [(400 + i, rows[3][1], 0) for i in range(10)]                       # ties
    rows += [(500, None, 0), (501, [float("nan")] * 8, 0), (502, [1.0, None], 0), (550, [2.0, 1.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, query_id int")
    got = sorted(map(tuple, topk.top_k(spark, table).collect()))
    vecs = {}
    for i, e, _ in rows:
        if e is not None and None not in e and not any(math.isnan(x) for x in e):
            v = [math.floor(256 * float(np.float32(x))) for x in e]
            vecs[i] = v + [0] * (8 - len(v))
    want = []
    for q in vecs:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(vecs[q], vecs[c])), c) for c in vecs if c != q)[:5]
            want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    assert got == sorted(want)
    assert topk.top_k(spark, table.limit(0)).count() == 0
    assert topk.top_k(spark, table.where("vec_id in (0, 1)")).collect()[0][:3] == (0, 1, 1)


def test_sharding(spark, docs, empty):
    hot = spark.range(3000).select((F.col("id") + 100).alias("doc_id"), F.lit("same text here").alias("text"))
    table = docs.select("doc_id", "text").union(hot)
    rows = sharding.shard_documents(spark, table, shards=4).collect()
    assert len(rows) == table.count()
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) - min(size.values()) <= max(r.size for r in rows)
    assert sharding.shard_documents(spark, empty).count() == 0


def test_pipeline_stages_take_effect(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    start = docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = []
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == start.columns
        sizes.append(docs.count())
    assert start.count() > sizes[0] >= sizes[1] > sizes[2] == sizes[3]
    packed = pipeline.run(spark, sf)
    assert packed.select("doc_id").distinct().count() == sizes[3]
    assert json.dumps(sizes)


CLASHES = ("stratum n_words kept base_failed quality toxic score held_out class_id n_links marks more bucket kind "
           "payload piece start length region island packing shard slot bundle g hot_g size tokens ids label").split()


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids beside texts, repeated rows, and columns with the names that operators use."""
    base = " ".join(f"word{i}" for i in range(120))
    rows = [(0, base), (1, base + " more"), (None, base + " tail"), (None, None), (5, None), (6, ""), (7, base), (7, base)]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    return table.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)]).coalesce(1).cache()


@pytest.fixture(scope="module")
def odd_labels(spark):
    return spark.createDataFrame([(0, 1, 0), (0, 1, 0), (1, None, None), (None, 1, 0), (7, 0, 0)],
                                 "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


def test_null_ids_and_clashing_names(spark, odd, odd_labels):
    want = sorted(str(r.doc_id) for r in odd.collect())
    words = public_tokenizers.path("word_bpe_49k.json")
    outs = {
        "bpe": bpe.token_digests(odd, public_tokenizers.path("byte_bpe_50k.json")),
        "suffix": suffix_dedup.repeated_strings(odd), "classifier": quality_fm.classify(odd, odd_labels),
        "substring": substring_dedup.window_digests(odd), "rules": quality_rules.score_documents(spark, odd, odd_labels),
        "near": chosen_path.near_duplicates(spark, odd), "sharding": sharding.shard_documents(spark, odd, 4),
        "packing": packing.pack_documents(spark, odd, words),
    }
    for name, out in outs.items():
        assert sorted(str(r.doc_id) for r in out.select("doc_id").collect()) == want, name
    assert outs["classifier"].where("doc_id is null and held_out").count() == 0
    assert {r.class_id for r in outs["near"].where("doc_id is null").collect()} == {None}


def test_only_empty_texts(spark, odd, odd_labels):
    """Batches without a single word."""
    bare = odd.where("coalesce(text, '') = ''")
    assert sorted(r.n_links for r in chosen_path.near_duplicates(spark, bare).collect()) == [0, 0, 0]
    assert [r.n_removed for r in substring_dedup.window_digests(bare).collect()] == [0, 0, 0]
    assert [r.n_words for r in quality_rules.score_documents(spark, bare, odd_labels).collect()] == [0, 0, 0]
    assert all(0 <= r.score <= 1 for r in quality_fm.classify(bare, odd_labels).collect())


def test_pipeline_stages_on_odd_tables(spark, odd, odd_labels, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    odd_labels.write.parquet(f"{tmp_path}/labels.parquet")
    # A null id changes no verdict: junk and copies without one go too.
    clash = odd.withColumn("row_key__", F.lit("x")).withColumn("given__", F.lit("y"))
    scored = quality_fm.classify(odd, odd_labels).where("doc_id is null and predicted = 1").count()
    for table in (odd, clash):
        for (name, stage), nulls in zip(pipeline.STAGES[:-1], (1, scored, 0, 2)):
            out = stage(spark, table, str(tmp_path))
            assert out.columns == table.columns, name
            assert out.where("doc_id is null").count() == nulls, name
            assert stage(spark, table.limit(0), str(tmp_path)).count() == 0, name
        kept = pipeline.near_duplicate_stage(spark, table, str(tmp_path))
        assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "5"]
    assert {(r.row_key__, r.given__) for r in pipeline.substring_dedup_stage(spark, clash, "").collect()} == {("x", "y")}


def _near_brute(rows):
    """Ids that stay: the least of each component of texts at 0.8 or more."""
    def shingles(t):
        w = re.findall("[^\x20\x09-\x0D]+", t or "")
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    at = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s or {()}:
            at[x].append(i)
    done = set()
    for ids in at.values():
        for a in ids:
            for b in ids:
                if a < b and (a, b) not in done:
                    done.add((a, b))
                    same = not sets[a] and not sets[b]
                    if same or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                        x, y = find(a), find(b)
                        root[max(x, y)] = min(x, y)
    return {i for i in root if find(i) == i}


def _windows_brute(rows):
    """Texts without the words of 13-word windows that a smaller document has."""
    words = {i: re.findall("[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first = {}
    for i, w in words.items():
        for k in range(len(w) - 12):
            x = tuple(w[k:k + 13])
            first[x] = min(first.get(x, i), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        out[i] = [x for x, g in zip(w, gone) if not g]
    return out


def test_pipeline_stages_against_brute_force(spark):
    from tokenizers import Tokenizer
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    ruled = pipeline.quality_rules_stage(spark, docs, sf).cache()
    kept = {r.doc_id for r in quality_rules.score_documents(spark, docs, labels).where("kept").collect()}
    assert {r.doc_id for r in ruled.collect()} == kept
    good = pipeline.quality_classifier_stage(spark, ruled, sf).cache()
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality_fm.classify(ruled, labels).where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in good.collect()]
    near = pipeline.near_duplicate_stage(spark, good, sf).cache()
    assert {r.doc_id for r in near.collect()} == _near_brute(rows)
    left = [(i, t) for i, t in rows if i in _near_brute(rows)]
    parts = pipeline.substring_dedup_stage(spark, near, sf).cache()
    got = {r.doc_id: r for r in parts.collect()}
    for i, words in _windows_brute(left).items():
        assert (got[i].text or "").split() == words and got[i].n_chars == len(got[i].text or "")
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = pipeline.packing_stage(spark, parts, sf).collect()
    per = collections.Counter()
    for r in packed:
        per[r.doc_id] += r.length
    assert per == {i: len(lib.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in got.items()}
    assert len({r.sequence_id for r in packed}) <= -(-sum(per.values()) // 2048) + 1


def test_pipeline_texts_that_share_an_id(spark, tmp_path):
    """Verdicts hold for the row, and no text is dropped for its doc_id."""
    pipeline = pytest.importorskip("corpus_pipeline")
    good, other = (" ".join(f"{w}{i}" for i in range(120)) for w in ("word", "term"))
    rows = [(3, good), (3, other), (3, "junk"), (3, good), (4, other), (5, good + " more"), (6, other.upper())]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    see = lambda out: sorted((r.doc_id, r.text) for r in out.collect())
    ruled = pipeline.quality_rules_stage(spark, docs, str(tmp_path))
    assert see(ruled) == sorted(r for r in rows if r[1] != "junk")
    near = pipeline.near_duplicate_stage(spark, ruled, str(tmp_path))
    assert len(see(near)) == 3
    assert {t.split()[0] for _, t in see(near)} == {"word0", "term0", "TERM0"}
    twice = spark.createDataFrame([(3, good), (3, other), (2, good)], "doc_id long, text string")
    assert see(pipeline.substring_dedup_stage(spark, twice, "")) == sorted([(2, good), (3, ""), (3, other)])


def test_topk_repeated_query_rows(spark):
    rows = [(0, [1.0, 1.0]), (0, [1.0, 1.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (None, [9.0, 9.0]), (50, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(7)).withColumn("v", F.lit(1))
    got = [tuple(r) for r in topk.top_k(spark, table).where("query_id = 0").orderBy("rank").collect()]
    assert got == [(0, 1, 1, 196608), (0, 2, 1, 196608), (0, 3, 50, 0)]
