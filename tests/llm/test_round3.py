"""MinHash near-dedup, periodic runs and spelling variants against brute force, on odd rows and skewed groups."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import LONG, SF0001

from mqtable.llm import gam, minhash, queries, runs, spelling, tokenbin


def texts_of(spark, name="documents"):
    return [tuple(r) for r in spark.read.parquet(f"{SF0001}/{name}.parquet").select("doc_id", "text").collect()]


def same(got, want):
    return sorted(got, key=str) == sorted(want, key=str)


# --- MinHash ------------------------------------------------------------------------------------


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return frozenset([tuple(words)] if 0 < len(words) < k else [tuple(words[i : i + k]) for i in range(len(words) - k + 1)])


def brute_components(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return [(d, len(s), least.get(g), d == least.get(g)) for (d, _), s, g in zip(rows, sets, group)]


def near_copies(n, words=40, seed=1):
    """Copies of one text with growing numbers of changed words, and some of unrelated texts."""
    rnd = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for _ in range(i % 4):
            text[rnd.randrange(words)] = f"x{rnd.randrange(3)}"
        out.append((n - i, " ".join(text)))
    return out + [(n + i, " ".join(f"u{rnd.randrange(9)}" for _ in range(30))) for i in range(1, 6)]


def test_minhash_equals_brute_force(spark):
    rows = near_copies(60)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert same([tuple(r) for r in got], brute_components(rows))


def test_minhash_cuts_large_groups(spark, monkeypatch):
    """A group far over its chunk size: chunks with the leader, then what is apart against the other chunks."""
    monkeypatch.setattr(minhash, "GROUP_ROWS", 8)
    rows = near_copies(90, words=60, seed=3)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_components(rows)
    assert same([tuple(r) for r in got], want) and 1 < len({r[2] for r in want}) < len(rows)


def test_minhash_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert same([tuple(r) for r in minhash.near_duplicates(odd_docs).collect()], brute_components(rows))
    assert minhash.near_duplicates(no_docs).count() == 0
    few = [(1, "A b\tc"), (2, "a B c"), (3, "a b c d"), (4, ""), (5, " \n"), (6, None), (6, None), (None, "a b c"), (None, "z z"), (None, "Z z")]
    df = spark.createDataFrame(few, "doc_id long, text string")
    assert same([tuple(r) for r in minhash.near_duplicates(df).collect()], brute_components(few))


def test_signatures_lose_no_pair():
    """Distances of pairs at the threshold follow the binomial that the allowed errors are drawn from."""
    errors, cuts = minhash.max_errors(85), minhash.chunk_cuts(minhash.max_errors(85))
    # by pigeonhole one chunk has so few errors that leaving them out finds the pair
    assert errors < (len(cuts) - 1) * (minhash.CHUNK_ERRORS + 1)
    rnd, seen = np.random.default_rng(2), []
    for _ in range(400):
        both = rnd.integers(0, 1 << 63, 200, np.uint64)
        a, b = np.r_[both[:185]], np.r_[both[:170], both[185:]]  # 170 of 200 shared
        x, y = (np.frombuffer(minhash.signature(s), ">u2") for s in (a, b))
        seen.append(int((x != y).sum()))
    assert abs(np.mean(seen) - 64 * 0.15) < 0.6 and max(seen) <= errors and np.std(seen) < 3.6


# --- periodic runs --------------------------------------------------------------------------------


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in found.items())


def sequences(kind, rnd):
    n = rnd.randrange(1, 30)
    block = [rnd.randrange(3) for _ in range(rnd.randrange(1, 9))] * n
    if kind == 0:
        return [rnd.randrange(2) for _ in range(4 * n)]
    if kind == 1:
        for _ in range(rnd.randrange(4)):
            block[rnd.randrange(len(block))] = rnd.randrange(3)
        return block
    if kind == 2:  # a Fibonacci word
        a, b = [0], [0, 1]
        for _ in range(rnd.randrange(1, 9)):
            a, b = b, b + a
        return b
    if kind == 3:  # periodic stretches that touch out of phase
        return ([0, 1] * n + [0]) * rnd.randrange(1, 5) + [0, 1] * rnd.randrange(20)
    return [x for _ in range(rnd.randrange(1, 5)) for x in [rnd.randrange(2) for _ in range(rnd.randrange(1, 5))] * n] * 2


@pytest.mark.parametrize("kind", range(5))
def test_runs_equal_brute_force(kind):
    rnd = random.Random(kind)
    for _ in range(250):
        w = sequences(kind, rnd)
        got = [tuple(int(x) for x in r) for r in zip(*runs.find_runs(np.array(w, np.int64)))]
        assert sorted((s, e, q) for s, e, q in got) == sorted(brute_runs(w)), w


def runs_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = sorted((s, q, e) for s, e, q in brute_runs(words))
    listed = "".join(f"{s},{e - s},{q}\n" for s, q, e in found)
    dropped = {i for s, q, e in found for i in range(s + q, e)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(((s - e, s, q) for s, q, e in found), default=None)
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *longest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_query_equals_brute_force(spark):
    rows = texts_of(spark)
    some = [r for r in rows if len((r[1] or "").split()) < 700]
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, SF0001).collect()}
    assert len(got) == len(rows) and all(got[d] == runs_row(d, t) for d, t in some)
    assert sum(r[1] > 0 for r in got.values()) > len(rows) / 20


def test_runs_odd_rows(spark, odd_docs, no_docs):
    short = odd_docs.where(f"text IS NULL OR length(text) < {len(LONG)}")
    want = [runs_row(*r) for r in short.select("doc_id", "text").collect()]
    assert same([tuple(r) for r in runs.detect_runs(short, plant=True).collect()], want)
    found = runs.detect_runs(odd_docs.where(f"length(text) = {len(LONG)}"), texts=True).first()
    # the long text ends in 2,000 equal words and repeats its first 30,000 with a period of 977 * 31
    assert "30000,2000,1\n" in found.runs and found.collapsed.endswith(" tail")
    assert runs.detect_runs(no_docs).count() == 0


def test_very_repetitive_texts_stay_fast():
    for period in (1, 2, 3, 1000):
        start, end, q = runs.find_runs(np.arange(100_000) % period)
        assert list(zip(start, end, q)) == [(0, 100_000, period)]


# --- spelling variants ----------------------------------------------------------------------------


def brute_spelling(rows):
    count = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            at = h % len(run)
            count[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    near, holes = defaultdict(set), defaultdict(list)
    for w in n:
        for i in range(len(w)):
            holes[i, w[:i], w[i + 1 :]].append(w)
            if (less := w[:i] + w[i + 1 :]) in n:
                near[w].add(less)
                near[less].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root))
    return out


COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def test_spelling_query_equals_brute_force(spark):
    got = queries.op13_spelling_variants(spark, SF0001).select(*COLUMNS).collect()
    assert same([tuple(r) for r in got], brute_spelling(texts_of(spark)))


def dense_words():
    rnd = random.Random(4)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.choice([5, 6, 7, 11]))) for _ in range(400)}
    long = "lettersandmore" * 12
    words |= {long, long[1:], long + "x", long[:50] + "q" + long[51:], "ÀÉÎõü×÷", "àÉÎõü×÷"}
    return [(i, (w + " ") * rnd.choice([1, 2, 3, 4, 9, 40])) for i, w in enumerate(sorted(words))]


def test_spelling_of_dense_words_in_chunks(spark, monkeypatch):
    rows = dense_words()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_spelling(rows)
    assert same([tuple(r) for r in spelling.spelling_variants(docs).select(*COLUMNS).collect()], want)
    monkeypatch.setattr(spelling, "CHUNK", 3)
    monkeypatch.setattr(spelling, "INDEX_BYTES", 0)  # 64 words a chunk is the least
    assert same([tuple(r) for r in spelling.spelling_variants(docs).select(*COLUMNS).collect()], want)


def test_spelling_odd_rows(spark, odd_docs, no_docs):
    thrice = odd_docs.unionAll(odd_docs).unionAll(odd_docs)
    rows = [tuple(r) for r in thrice.select("doc_id", "text").collect()]
    assert same([tuple(r) for r in spelling.spelling_variants(thrice).select(*COLUMNS).collect()], brute_spelling(rows))
    assert spelling.spelling_variants(no_docs).count() == 0


def test_spelling_counts_are_flushed(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 3)
    import pyarrow as pa

    rows = [{"doc_id": i % 5, "text": "alpha betas gamma delta epsilon " * 3} for i in range(20)]
    total = Counter()
    for out in spelling._counter(iter([pa.RecordBatch.from_pylist(rows)])):
        for word, n in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            total[word] += n
    want = Counter(w.decode() for r in rows for w in spelling.words_of(r["doc_id"], r["text"].encode()))
    assert total == {w: n for w, n in want.items() if len(w) >= 5}


# --- mends ----------------------------------------------------------------------------------------


def test_encoder_equals_the_library_over_chunks():
    import public_tokenizers

    encode = tokenbin.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(1)
    parts = ["word", "Word,", "don't", "a\nb", "x\t", "\ny", "", "é" * 3, "q" * 90, "12345", "(see)", " z", "漢字", "end.\n"]
    texts = [" ".join(rnd.choice(parts) + str(rnd.randrange(9)) * rnd.randrange(2) for _ in range(rnd.randrange(30))) for _ in range(600)]
    want = [encode.whole(t) for t in texts]
    assert [p for i in range(0, 600, 100) for p in encode.encode(texts[i : i + 100])] == want
    assert not any(len(p) > tokenbin.CACHED_CHARS for p in encode.now)


def test_encoder_generations(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(tokenbin, "CACHE_ENTRIES", 20)
    encode = tokenbin.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"often rare{i} other{i} often again" for i in range(50)]
    assert [encode(t) for t in texts] == [encode.whole(t) for t in texts]
    assert len(encode.now) + len(encode.old) <= 40


def test_encoder_equals_the_library_at_every_cut():
    import public_tokenizers

    encode = tokenbin.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(2)
    parts = [" ", " ", "  ", "\n", "\t", "\n\n", "'", "'s", "'ll", ".", ".'", "(", "_", "-", "x", "End", "7", "é", "×", "÷", "½", "«", "ǅ", "ɏ", "ß", "\xad", "\xa0", "\r", "漢", "<|", "<|endoftext|>"]
    for _ in range(300):
        texts = ["".join(rnd.choice(parts[: rnd.choice((25, len(parts)))]) for _ in range(rnd.randrange(14))) for _ in range(rnd.randrange(40))]
        for text, got in zip(texts, encode.encode(texts), strict=True):
            assert got == encode.whole(text), repr(text)


def test_encoder_learns_a_word_once(monkeypatch):
    import public_tokenizers

    encode, asked = tokenbin.Encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    library = encode._ids
    monkeypatch.setattr(encode, "_ids", lambda text: asked.append(text) or library(text))
    texts = [f"Some word{mark}\nNext{mark} (word)  word\n" for mark in ("", ".", "!", "...", " -", "%%%", "###")]
    want = [encode.pack(library(text)) for text in texts]
    assert encode.encode(texts) == want
    # marks, line ends and runs of white space do not make a known word a new one, nor a text unusual
    assert "".join(asked).count("word") == 2 and len(asked) < len(texts)
    asked.clear()
    assert encode.encode(texts) == want and not asked


def test_repeated_tail_is_seen():
    words = [f"w{i}" for i in range(96)]
    at = [gam.FEATURES.index(f) for f in ("least_distinct", "most_repeats")]
    plain, tail = gam.features(" ".join(words)), gam.features(" ".join(words[:64] + ["same"] * 32))
    assert plain[at[0]] == 1.0 and plain[at[1]] == 0.0 and tail[at[0]] < 0.6 and tail[at[1]] > 0.4


def test_contradictory_labels_are_not_learnt(spark):
    docs = spark.createDataFrame([(i, ("good words here " if i % 2 else "!!! ||| 000 ") * 8) for i in range(60)], "doc_id long, text string")
    right = [(i, i % 2) for i in range(60)]
    wrong = [(i, 1 - i % 2) for i in range(0, 60, 3)]
    scores = []
    for labels in (right + wrong, [x for x in right if x[0] % 3] + [(0, None), (999, 1)]):
        df = spark.createDataFrame(labels, "doc_id long, quality int")
        scores.append({r.doc_id: r.score for r in gam.classify(docs, df).collect()})
    assert scores[0] == scores[1]
