"""Line quality, lexical search and token alignment against brute force on small texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakegate.llm import lexical_search, line_quality, token_alignment
from lakegate.llm.perfect_hash import KeyTable, PerfectHash, shard_of
from lakegate.llm.queries import tokenizer_file

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Names that the operators use inside.
SCHEMA = "doc_id bigint, text string, item int, term bigint, pair bigint, n_a bigint, kept string, batch binary"


def corpus() -> list[tuple]:
    rng = random.Random(11)
    words = ["the", "of", "Straße", "naïve", "漢字", "token", "x1", "it's", "re-do", "a#b", "A", "𝒳y"]
    texts: list[str | None] = [None, "", " \n\t\r\x0b ", ".", "one two", "a▁b", "x<|endoftext|> y <s> <0x41>"]
    texts += ["Home | About | Contact\nRead more\nAll rights reserved.", "{ javascript }\n" * 8, "wow!! so!! good!! it."]
    for _ in range(25):
        lines = [" ".join(rng.choices(words, k=rng.randint(1, 40))) + rng.choice([".", "", "!", " ", "…"]) for _ in range(rng.randint(1, 9))]
        texts.append(rng.choice(["\n", "\n\n", "  \n"]).join([*lines, lines[0]]))
    texts += [texts[12], texts[12], "again and again " * 60, "  double  spaces and others é é ", "\x00 nul"]
    texts.append(" ".join(rng.choices(words, k=30_000)))
    rows = [(i, t, 1, 2, 3, 4, "k", b"") for i, t in enumerate(texts, 1)]
    return [*rows, rows[15], (None, "an id is missing, the token too", 1, 2, 3, 4, "k", b"")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df, *columns) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def _base(text: str | None) -> tuple:
    text = text or ""
    words = WORDS.findall(text)
    times = Counter(tuple(words[p : p + 8]) for p in range(len(words) - 7))
    hit = {p + k for p in range(len(words) - 7) if times[tuple(words[p : p + 8])] > 1 for k in range(8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, again, len(hit), failed


def test_line_quality_base(docs, empty):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = line_quality.line_quality(docs)
    assert found(got, *columns) == sorted(((r[0], *_base(r[1])) for r in corpus()), key=repr)
    assert all(not r["kept"] for r in got.where("base_failed").collect())
    assert line_quality.line_quality(empty).count() == 0


@pytest.mark.parametrize(
    "line,rule",
    [
        (b"A whole sentence.", None), (b"no end", "punctuation"), (b"word " * 30, None),
        ("Zitat »so« und „so”".encode(), None), (b"Buy $$$ now.", "punctuation"),
        (b"Yes!! No!! Why??", "punctuation"), (b"a - b. \xc2\xb7 c \xe2\x80\xa2 d.", "navigation"),
        (b"Read more...", "navigation"), (b"Home is where one is at ease.", None),
        (b"We use cookies.", "boilerplate"), (b"\t COPYRIGHT by us. ", "boilerplate"),
    ],
)
def test_line_rules(line, rule):
    assert line_quality.failing_rule(line, line_quality.Rules()) == rule


def test_clean_drops_lines_then_documents(spark):
    good = "This is a sentence with quite a few words in it, number {}."
    lines = [good.format(i) for i in range(6)]
    texts = ["\n".join([lines[0], "Read more.", *lines[1:]]), "\n".join([*lines[:2], *["privacy policy " * 20] * 2])]
    rows = spark.createDataFrame(list(enumerate(texts)), "key int, body string")
    got = line_quality.clean(rows, line_quality.Rules(repeat_percent=100), id_col="key", text_col="body").collect()
    assert [tuple(r) for r in got] == [(0, "\n".join(lines))]


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_repeated_words(words, window):
    times = Counter(tuple(words[p : p + window]) for p in range(len(words) - window + 1))
    hit = {p + k for p in range(len(words) - window + 1) if times[tuple(words[p : p + window])] > 1 for k in range(window)}
    assert line_quality.repeated_words(np.array(words, np.int64), window) == len(hit)


ITEMS = [
    ("i1", "The token, the TOKEN and the 漢字!", 0), ("i2", "straße Straße nowhere", 1), ("i2", "x1 other text", 1),
    ("i3", "", 2), (None, "naïve it", 3), ("i4", None, 3), ("i1", "The token, the TOKEN and the 漢字!", 5),
    ("i5", "unheard-of-thing", 0), ("i6", "…!?", 1),
]


def _ranking(k: int) -> list[tuple]:
    rows = [(r[0], Counter(TERMS.findall((r[1] or "").translate(FOLD)))) for r in corpus()]
    rows = [(i, c) for i, c in rows if c]
    n, total = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in {(i, t or "") for i, t, _ in ITEMS}:
        query = Counter(TERMS.findall(text.translate(FOLD)))
        scores = []
        for doc_id, c in rows:
            m = 100 - 75 + (75 * sum(c.values()) * n) // total
            score = sum(
                q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, q in query.items() if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k,block", [(10, 1 << 20), (3, 1), (10, 40)])
def test_search(spark, docs, empty, k, block):
    items = spark.createDataFrame(ITEMS, "item_id string, text string, score int")
    got = lexical_search.search(docs, items, k=k, block_bytes=block)
    assert found(got, "item_id", "rank", "doc_id", "score") == _ranking(k)
    assert lexical_search.search(empty, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


def test_search_counts_over_parts(monkeypatch):
    tool = lexical_search.Items([b"red green", b"blue"])
    text = b"Red,green red  blueish blue\n" * 50
    whole = tool.count(text)
    monkeypatch.setattr(lexical_search, "PART", 7)
    assert tool.count(text) == whole
    assert {t: whole[1][tool.numbers[t]] for t in (b"red", b"green", b"blue")} == {b"red": 100, b"green": 50, b"blue": 50}


def _aligned() -> list[tuple]:
    a = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    alphabet = token_alignment.byte_alphabet()
    documents = []
    for doc_id, text, *_ in corpus():
        made = None
        if text:
            encoded = a.encode(" " + text, add_special_tokens=False)
            ids_b = b.encode(text)
            bytes_a = [bytes(alphabet[c] for c in t) for t in encoded.tokens]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                made = _links(encoded.ids, bytes_a, ids_b, bytes_b)
        documents.append((doc_id, made))
    counts = Counter(p for _, made in documents if made for p in set(made[3]))
    best: dict[int, int] = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, made in documents:
        if made is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        ids_a, ids_b, groups, links = made
        n_best = sum(counts[p] == best[p[0]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest()
        out.append((doc_id, len(ids_a), len(ids_b), groups.count(";") + 1, len(links), n_best, sum(counts[p] for p in links), digest))
    return sorted(out, key=repr)


def _links(ids_a, bytes_a, ids_b, bytes_b):
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
    starts_a, starts_b = ends_a - [len(x) for x in bytes_a], ends_b - [len(x) for x in bytes_b]
    links, at = [], 0
    for i, x in enumerate(ids_a):
        while ends_b[at] <= starts_a[i]:
            at += 1
        j = at
        while j < len(ids_b) and starts_b[j] < ends_a[i]:
            links.append((x, ids_b[j]))
            j += 1
    groups, p, q = [], 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        i, j = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
        groups.append(",".join(map(str, ids_a[p:i])) + "|" + ",".join(map(str, ids_b[q:j])))
        p, q = i, j
    return ids_a, ids_b, ";".join(groups), links


BYTE_LEVEL = token_alignment.ByteLevel(tokenizer_file("byte_bpe_50k.json"))
ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("table_pairs", [4_000_000, 40])
def test_token_alignment(docs, empty, table_pairs):
    paths = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    got = token_alignment.align(docs, *paths, table_pairs=table_pairs)
    assert found(got, *ALIGNED) == _aligned()
    assert token_alignment.align(empty, *paths).count() == 0


@pytest.mark.parametrize("part,tokens", [(200, 300), (1, 1)])
def test_parts_and_slices_change_nothing(monkeypatch, part, tokens):
    tool = token_alignment.Pair(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    texts = [(r[1] or "").encode() for r in corpus()]

    def groups():
        a, b, parts = [], [], []
        for found in tool.encode(texts):
            a.append(b"".join(x.astype(tool.dtype).tobytes() for x, _ in found))
            b.append(b"".join(y.astype(tool.dtype).tobytes() for _, y in found))
            parts.append([n for x, y in found for n in (len(x), len(y))])
        columns = {"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "parts": pa.array(parts, pa.list_(pa.int32()))}
        out: dict[int, list[bytes]] = defaultdict(list)
        for begin, rows, _, sequences in token_alignment.sliced(pa.RecordBatch.from_pydict(columns), tool.dtype):
            for k, name in enumerate(token_alignment.align_tokens(tool, sequences, True).names):
                out[begin + k if rows else begin].append(name)
        return {row: b";".join(names) for row, names in out.items()}

    whole = groups()
    assert len(whole) == len(texts)
    monkeypatch.setattr(token_alignment, "PART", part)
    monkeypatch.setattr(token_alignment, "SLICE_TOKENS", tokens)
    assert groups() == whole


def test_one_very_long_text(spark):
    paths = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    text = "Some words, again and again: naïve tokens! " * 60_000
    rows = spark.createDataFrame([(1, text), (2, "again and"), (3, text[:-1])], "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: r for r in token_alignment.align(rows, *paths, with_groups=True).collect()}
    encoded = Tokenizer.from_file(paths[0]).encode(" " + text, add_special_tokens=False)
    assert got[1]["n_a"] == len(encoded.ids)
    assert got[1]["groups"].count(";") + 1 == got[1]["n_groups"]
    assert ",".join(g.split("|")[0] for g in got[1]["groups"].split(";")) == ",".join(map(str, encoded.ids))
    # "again" and "and" (after a space) are in all three documents, every other pair in two.
    assert got[2]["count_sum"] == 3 * got[2]["n_links"]
    assert got[3]["groups_sha256"] == hashlib.sha256(got[3]["groups"].encode()).hexdigest()


@given(st.text(st.characters(codec="utf-8"), max_size=60))
@settings(max_examples=400, deadline=None)
def test_ranks_give_the_library_ids(text):
    tool = BYTE_LEVEL
    assert tool.fast is not None
    for whole in (text, " " + text + "<|endoftext|>", text + "it's  \n " + text):
        want = tool.library.encode(whole, add_special_tokens=False).ids
        assert tool.encode(whole.encode()).tolist() == want
    long = (text + "ab") * 1200
    assert tool.encode(long.encode()).tolist() == tool.library.encode(long, add_special_tokens=False).ids


@given(st.sets(st.integers(0, 2**62), max_size=400))
@settings(max_examples=60, deadline=None)
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.int64)
    tool = PerfectHash.unpacked(PerfectHash.build(keys).packed())
    assert sorted(tool(keys).tolist()) == list(range(len(keys)))
    shards = [keys[shard_of(keys, 3) == s] for s in range(3)]
    hashes = [PerfectHash.build(k) for k in shards]
    ordered = [k[np.argsort(h(k))] if len(k) else k for h, k in zip(hashes, shards, strict=True)]
    table = KeyTable([h.packed() for h in hashes], ordered)
    assert sorted(table.find(keys).tolist()) == list(range(len(keys)))
    foreign = keys + 2**62 + 1
    assert (table.find(foreign) == -1).all()
