"""Operators against brute force on small texts: nulls, empty texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakegate.llm import (
    chunked_bpe,
    decontaminate,
    encoder,
    exact_dedup,
    jaccard_join,
    kd_sharding,
    lm_scoring,
    quality,
    substring_dedup,
    token_files,
)
from lakegate.llm.queries import tokenizer_file

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that the operators use inside.
CLASH = "key bigint, hash bigint, node bigint, bucket int"
SCHEMA = f"doc_id bigint, text string, {CLASH}"


def corpus() -> list[tuple]:
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=60)
    texts: list[str | None] = [None, "", " \n\t ", "one", "Two words", "é ü 漢字 <|endoftext|> x"]
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(40, 150))
        texts += [" ".join(base), " ".join(base)]
        for _ in range(2):
            near = list(base)
            near[rng.randrange(len(near))] = "changed"
            texts.append("\n".join(near))
        texts.append(" ".join(base[:20] + passage + base[20:]).upper())
    texts.append(" ".join(rng.choices(vocabulary, k=20_000)))
    texts.append("again " * 100)
    rows = [(i, t, 1, 2, 3, 4) for i, t in enumerate(texts, 1)]
    return [*rows, rows[10], (None, "an id is missing", 1, 2, 3, 4)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df, *columns) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_substring_dedup(docs, empty):
    words = [(r[0], WORDS.findall(r[1] or "")) for r in corpus()]
    times = Counter(tuple(w[p : p + 35]) for _, w in words for p in range(len(w) - 34))
    want = []
    for doc_id, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - 34):
            if times[tuple(w[p : p + 35])] > 1:
                gone[p : p + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert found(substring_dedup.substring_dedup(docs), *columns) == sorted(want, key=repr)
    assert substring_dedup.substring_dedup(empty).count() == 0


@pytest.mark.parametrize("window,expected", [(35, [18, 35]), (16, [16]), (100, [25, 50, 100])])
def test_levels_double(window, expected):
    assert substring_dedup.levels(window) == expected


def _linked(n: int, percent: int) -> list[tuple]:
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = [(r[0], WORDS.findall((r[1] or "").translate(fold))) for r in corpus()]
    sets = [{tuple(w[p : p + n]) for p in range(max(1, len(w) - n + 1))} if w else set() for _, w in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    return sorted(((r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group, strict=True)), key=repr)


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_join(docs, empty, n, percent):
    join = jaccard_join.Join(n, percent)
    got = jaccard_join.near_components(docs, join)
    assert found(got, "doc_id", "n_shingles", "component_id") == _linked(n, percent)
    assert jaccard_join.near_components(empty, join).count() == 0


@pytest.mark.parametrize("steps", jaccard_join.BAND_STEPS)
def test_jaccard_join_with_every_band_width(docs, monkeypatch, steps):
    monkeypatch.setattr(jaccard_join, "BAND_STEPS", (steps,))
    got = jaccard_join.near_components(docs, jaccard_join.Join(2, 70))
    assert found(got, "doc_id", "n_shingles", "component_id") == _linked(2, 70)


@pytest.mark.parametrize("percent", [50, 75, 80, 90, 97])
@pytest.mark.parametrize("steps", jaccard_join.BAND_STEPS)
def test_partners_are_at_most_one_band_apart(percent, steps):
    join = jaccard_join.Join(5, percent, steps)
    for size in range(1, 3000):
        least = -(-size * percent // 100)
        assert join.band(size) - join.band(least) <= 1
        assert join.begin(join.band(size)) <= size < join.begin(join.band(size) + 1) or not join.band(size)


def test_jaccard_join_of_equal_sets_only(docs):
    got = jaccard_join.near_components(docs, jaccard_join.Join(3, 100))
    assert found(got, "doc_id", "n_shingles", "component_id") == _linked(3, 100)


def test_jaccard_join_has_no_highest_band(spark):
    join = jaccard_join.Join(1, 98)
    assert join.band(70_000) > 59
    words = [f"w{i}" for i in range(70_000)]
    rows = [(1, " ".join(words)), (2, " ".join(["changed", *words[100:]]))]
    got = jaccard_join.near_components(spark.createDataFrame(rows, "doc_id bigint, text string"), join)
    assert found(got, "doc_id", "n_shingles", "component_id") == [(1, 70_000, 1), (2, 69_901, 1)]


def test_drop_near_copies_keeps_one_of_each(docs):
    left = jaccard_join.drop_near_copies(docs, jaccard_join.Join(5, 80))
    assert left.columns == docs.columns
    want = {i for i, n, c in _linked(5, 80) if i == c or not n}
    assert {r["doc_id"] for r in left.collect()} == want


def test_lm_scores(docs, empty):
    words = [(r[0], WORDS.findall(r[1] or "")) for r in corpus()]
    learnt = [w for i, w in words if i is not None and i % 2]
    counts, above = Counter(), Counter()
    for w in learnt:
        for n in (1, 2, 3):
            padded = [None] * (n - 1) + w
            for p in range(len(w)):
                counts[tuple(padded[p : p + n])] += 1
                above[n, tuple(padded[p : p + n - 1])] += 1
    total = sum(map(len, learnt))

    def log_share(gram: tuple) -> float:
        if counts[gram]:
            return math.log(counts[gram] / above[len(gram), gram[:-1]])
        return math.log(0.5 / total) if len(gram) == 1 else math.log(0.4) + log_share(gram[1:])

    want = sorted(((i, len(w), sum(log_share(tuple(([None, None] + w)[p : p + 3])) for p in range(len(w)))) for i, w in words), key=repr)
    got = found(lm_scoring.score(docs, docs.where("doc_id % 2 = 1")), "doc_id", "n_words", "log_score")
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])
    assert lm_scoring.score_corpus(empty).count() == 0
    unseen = lm_scoring.score(docs, empty)
    assert unseen.count() == docs.count()


def test_lm_scores_of_a_corpus_leave_out_the_own_text(docs):
    words = [(r[0], WORDS.findall(r[1] or "")) for r in corpus()]

    def counted(w: list[str]) -> Counter:
        padded = [None, None, *w]
        grams = Counter(tuple(padded[p + 3 - n : p + 3]) for n in (1, 2, 3) for p in range(len(w)))
        above = Counter()
        for gram, k in grams.items():
            above[len(gram), gram[:-1]] += k
        return grams + above

    everything = sum((counted(w) for _, w in words), Counter())
    want = []
    for i, w in words:
        mine = counted(w)

        def log_share(gram: tuple, mine=mine) -> float:
            left, above = everything[gram] - mine[gram], (len(gram), gram[:-1])
            if left:
                return math.log(left / (everything[above] - mine[above]))
            if len(gram) == 1:
                return math.log(0.5 / max(1, everything[above] - mine[above]))
            return math.log(0.4) + log_share(gram[1:])

        padded = [None, None, *w]
        want.append((i, len(w), sum(log_share(tuple(padded[p : p + 3])) for p in range(len(w)))))
    want.sort(key=repr)
    got = found(lm_scoring.score_corpus(docs), "doc_id", "n_words", "log_score")
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


@pytest.mark.parametrize("order", [1, 2, 4])
def test_lm_scores_do_not_depend_on_slices_and_buckets(docs, monkeypatch, order):
    columns = "doc_id", "n_words", "log_score"
    for whole, other in (
        (lm_scoring.score_corpus, docs),
        (lambda d, order: lm_scoring.score(d, docs.where("doc_id % 2 = 1"), order=order), docs),
    ):
        want = found(whole(other, order=order), *columns)
        with monkeypatch.context() as m:
            m.setattr(lm_scoring, "SLICE_BYTES", 3000)
            m.setattr(lm_scoring, "LEAST_BUCKETS", 5)
            got = found(whole(other, order=order), *columns)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_lm_counts_and_questions_are_sent_once(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(50)], k=500)) for _ in range(40)]
    rows = spark.createDataFrame([(0, t.encode()) for t in texts], "slice bigint, text binary")
    sent = lm_scoring._asked(rows, (3,), 4, True).collect()
    assert len(sent) == 4
    distinct = {g for t in texts for w in [["", "", *t.split()]] for g in zip(w, w[1:], w[2:], strict=False)}
    assert sum(len(r["grams"]) for r in sent) == 8 * len(distinct)
    # A count, and how often the n-gram ends a text, take a byte each; nothing else goes along.
    assert sum(len(r["counts"]) + len(r["ends"]) for r in sent) == 2 * len(distinct)


def test_exact_groups(docs, empty):
    rows = corpus()
    size = Counter(r[1] or "" for r in rows)
    got = exact_dedup.exact_groups(docs, keep=exact_dedup.LARGEST)
    keep = {t: max((r[0] for r in rows if (r[1] or "") == t and r[0] is not None), default=None) for t in size}
    want = sorted(((r[0], keep[r[1] or ""], size[r[1] or ""], r[0] == keep[r[1] or ""]) for r in rows), key=repr)
    assert found(got, "doc_id", "keep_id", "group_size", "kept") == want
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns and left.count() == len(size)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_contamination(spark, docs, empty):
    rows = corpus()
    long = next(r[1] for r in rows if r[1] and len(r[1]) > 300).split()
    items = [(1, " ".join(long[5:25])), (2, "two WORDS"), (3, None), (4, ""), (None, "one"), (2, "two WORDS")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    item_words = [(str(i), re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())) for i, t in items if i and t]
    want = []
    for r in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r[1] or "").lower())
        hit, owners = set(), set()
        for item, x in item_words:
            n = min(10, len(x))
            grams = {tuple(x[p : p + n]) for p in range(len(x) - n + 1)}
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in grams:
                    hit.update(range(p, p + n))
                    owners.add(item)
        want.append((r[0], len(w), len(hit), sorted(owners)))
    for size in (1, decontaminate.BLOCK_BYTES):
        got = decontaminate.contamination(docs, bench, block_bytes=size).withColumn("n_hit", decontaminate.n_hit())
        assert found(got, "doc_id", "n_words", "n_hit", "items") == sorted(want, key=repr)
    cleaned = decontaminate.decontaminate(docs, bench, max_coverage=0.5)
    again = decontaminate.contamination(cleaned, bench)
    assert again.where(F.size("spans") > 0).count() == 0
    gone = {r[0] for r, x in zip(rows, want, strict=True) if x[2] > 0.5 * x[1]}
    assert {r["doc_id"] for r in cleaned.collect()} == {r[0] for r in rows} - gone
    assert decontaminate.contamination(empty, bench).count() == 0


def test_decontaminate_does_not_depend_on_blocks(spark, docs):
    a, b, p, x = ([f"{c}{i}" for i in range(100)] for c in "abpx")
    items = [(1, " ".join(a[:30])), (2, " ".join(b[:30])), (3, " ".join(p[:12])), (4, " ".join(p[6:18])), (5, " ".join(x[:10])), (6, " ".join(x[10:20]))]
    texts = [
        a[:30] + [f"y{i}" for i in range(40)] + b[:30],  # 60 of 100 words, 30 by each item
        [*p[:18], *(f"y{i}" for i in range(30))],  # 18 words of two items that overlap
        x[:5] + x[10:20] + x[5:10] + [f"y{i}" for i in range(30)],  # neighbours by a cut only
        x[10:15] + x[:10] + x[15:20] + [f"y{i}" for i in range(30)],
        [f"y{i}" for i in range(30)],
    ]
    rows = spark.createDataFrame([(i, " ".join(t), -1, 0) for i, t in enumerate(texts)], "doc_id bigint, text string, n_chars int, spans int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    tail = " ".join(f"y{i}" for i in range(30))
    want = [(1, " " + tail), (2, " ".join([*x[:5], "", *x[5:10], tail])), (3, " ".join([*x[10:15], "", *x[15:20], tail])), (4, tail)]
    assert sum(map(bool, decontaminate.item_blocks(bench, "item_id", "text", 10))) == len(items)
    for size in (decontaminate.BLOCK_BYTES, 10):
        got = decontaminate.decontaminate(rows, bench, block_bytes=size)
        assert got.columns == rows.columns
        assert found(got, "doc_id", "text") == want
        assert found(got, "n_chars", "spans") == sorted(((len(t), 0) for _, t in want), key=repr)
    long = next(r[1] for r in corpus() if r[1] and len(r[1]) > 300).split()
    bench = spark.createDataFrame([(1, " ".join(long[5:25])), (2, "two WORDS"), (3, " ".join(long[15:40]))], "item_id bigint, text string")
    one = decontaminate.decontaminate(docs, bench, max_coverage=0.3)
    several = decontaminate.decontaminate(docs, bench, max_coverage=0.3, block_bytes=60)
    assert found(one, *docs.columns) == found(several, *docs.columns)


def test_chunked_bpe_equals_the_library(docs, empty):
    path = tokenizer_file("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    want = []
    for r in corpus():
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], ids, tokenizer.decode(ids, skip_special_tokens=False)))
    got = chunked_bpe.encode_decode(docs, path, chunk_bits=5)
    assert found(got, "doc_id", "ids", "decoded") == sorted(want, key=repr)
    assert chunked_bpe.encode_decode(empty, path).count() == 0


def _odd_texts(n: int) -> list[bytes]:
    rng = random.Random(11)
    words = ["plain", "Two,", "don't", "", "é", "\u0301x", "漢字", "x\u0301", "\n", "a\nb", "\t", "ünder", "“quoted”", "1234", "end."]
    clean = [f"w{i}" for i in range(40)]
    return [" ".join(rng.choices(words if i % 3 else clean, k=rng.randint(1, 60)) + rng.choices(clean, k=i % 7)).encode() for i in range(n)]


def test_chunk_encoder_with_odd_ends_and_a_turning_memo():
    path = tokenizer_file("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = _odd_texts(300)
    for limit in (10, 10_000):
        tool = chunked_bpe.ChunkEncoder(path, bits=6)
        tool.pieces.limit = limit
        for text in texts:
            assert tool.encode([text])[0].tolist() == tokenizer.encode(text.decode(), add_special_tokens=False).ids


def test_parts_are_cut_as_texts_are():
    for text in _odd_texts(300):
        parts = text.split(b" ")
        dirty = {p for p in parts[1:-1] if not (encoder.safe_start(p) and encoder.safe_end(p))}
        first, *rest = encoder.cut_at_spaces(text)
        assert chunked_bpe.cut_parts(parts, dirty) == [first, *(p[1:] for p in rest)]


def test_frequent_pieces_outlive_a_turn_of_the_memo(monkeypatch):
    tool = chunked_bpe.ChunkEncoder(tokenizer_file("word_bpe_49k.json"))
    tool.pieces.limit = 50
    learnt = Counter()
    learn = tool.pieces.learn
    monkeypatch.setattr(tool.pieces, "learn", lambda pieces: learnt.update(new := list(pieces)) or learn(new))
    for i in range(20):
        rare = [f"rare{i}x{k}" for k in range(60)]
        tool.encode([" ".join(["begin", *(w for r in rare for w in (r, "often", "common")), "end"]).encode()])
    assert learnt[b"often"] == learnt[b"common"] == 1


def test_token_files_round_trip(spark, docs, empty):
    path = tokenizer_file("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    folder = token_files.new_folder(spark, "test-ids")
    token_files.write_token_files(docs, folder, path)
    got = token_files.read_token_files(token_files.read_index(spark, folder), folder, path).collect()
    want = []
    for r in corpus():
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want.append((r[0], len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)), ids))
    assert sorted(((g["doc_id"], g["n_tokens"], g["ids_crc32"], g["ids"]) for g in got), key=repr) == sorted(want, key=repr)
    at = 0
    for g in sorted(got, key=lambda g: g["start"]):
        assert g["start"] == at
        at += g["n_tokens"]
    folder = token_files.new_folder(spark, "test-none")
    token_files.write_token_files(empty, folder, path)
    assert token_files.read_token_files(token_files.read_index(spark, folder), folder, path).count() == 0


def test_quality(spark, docs, empty):
    good = [(i, " ".join(random.Random(i).choices([f"word{k}" for k in range(500)], k=80)) + ".") for i in range(100)]
    bad = [(i, "BUY NOW!!! $$$ " * 30) for i in range(100, 200)]
    rows = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i in range(200)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    got = quality.classify(rows, labels).where("held_out").collect()
    assert got and all(g["predicted"] == int(g["doc_id"] < 100) for g in got)
    assert quality.classify(docs, labels).where("score between 0 and 1").count() == docs.count()
    assert quality.classify(empty, labels).count() == 0
    assert quality.classify(docs, labels.limit(0)).count() == docs.count()


def test_quality_learns_without_a_second_python_worker(spark, docs, monkeypatch):
    """No Python step feeds another one inside a task: two workers for each core would stay."""
    learnt = []
    monkeypatch.setattr(quality, "train", lambda found, labels, train=quality.train: learnt.append(found) or train(found, labels))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert quality.keep_good(docs, labels).count() == docs.count()
    assert "MapInArrow" not in learnt[0]._jdf.queryExecution().executedPlan().toString()


def test_kd_shards(docs, empty):
    placed = kd_sharding.kd_shards(kd_sharding.metadata(docs.withColumn("lang", F.lit("a")).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.char_length("text"))), shards=8)
    rows = placed.collect()
    assert len(rows) == docs.count()
    for shard in {r["shard"] for r in rows}:
        assert 0 <= shard < 8
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
