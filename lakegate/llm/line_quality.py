"""Quality rules, lines first: failing lines are removed, then documents that lost too much go."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import content, pick, ship

#: ASCII white space, as bytes.split() knows it: the blanks of [^\x20\x09-\x0D]+.
BLANKS = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
#: A line of prose ends in one of these.
LINE_ENDS = (".", "!", "?", "…", ":", ";", ")", "]", '"', "'", "”", "’", "»", "。", "！", "？", "؟", "।")
SEPARATORS = ("|", "»", "›", "•", "·", ">")
#: What a short menu line begins with.
MENU_WORDS = (
    "home", "menu", "search", "next", "previous", "read more", "log in", "login", "sign in",
    "sign up", "share", "back to top", "skip to content", "contact us", "about us", "sitemap",
)
BOILERPLATE = (
    "javascript", "cookie", "terms of use", "terms of service", "privacy policy",
    "all rights reserved", "copyright", "©", "licensed under", "released under the",
    "lorem ipsum", "subscribe to", "click here", "{", "}",
)
_BLANK = re.compile(rb"[\x09-\x0D\x20]")
_RUN = re.compile(rb"[!?]{2,}")
#: Text split into words at once.
_PART = 1024 * 1024


@dataclass(frozen=True)
class Rules:
    """Thresholds; a line is judged by itself, in this order of rules.

    punctuation: it does not end like a sentence (which a line of ``long_line`` words or more need
    not, as prose that was cut short), or has more than ``symbols_percent`` symbols per 100 words, or ``runs`` or more runs of ``!`` and ``?``. navigation: ``separators`` or more menu
    separators, or at most ``menu_words`` words that begin like a menu. boilerplate: it holds a
    known phrase. A line without a word is neither judged nor counted as lost.
    """

    min_words: int = 20
    window: int = 8
    repeat_percent: int = 30
    long_line: int = 30
    symbols_percent: int = 10
    runs: int = 3
    separators: int = 2
    menu_words: int = 4
    max_lost_percent: int = 50


_ENDS = tuple(x.encode() for x in LINE_ENDS)
_SEPARATORS = tuple(x.encode() for x in SEPARATORS)
_MENU = tuple(x.encode() for x in MENU_WORDS)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())


def failing_rule(line: bytes, rules: Rules) -> str | None:
    """The first rule that a line (with a word) fails."""
    line = line.strip(BLANKS)
    n = len(line.split())
    symbols = sum(map(line.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    if n < rules.long_line and not line.endswith(_ENDS):
        return "punctuation"
    if 100 * symbols > rules.symbols_percent * n:
        return "punctuation"
    if (b"!" in line or b"?" in line) and len(_RUN.findall(line)) >= rules.runs:
        return "punctuation"
    if sum(map(line.count, _SEPARATORS)) >= rules.separators:
        return "navigation"
    low = line.lower()
    if n <= rules.menu_words and low.startswith(_MENU):
        return "navigation"
    return "boilerplate" if _BOILERPLATE.search(low) else None


def word_numbers(text: bytes) -> np.ndarray:
    """The words as numbers, equal words alike. Words are split a part of the text at a time."""
    numbers: dict[bytes, int] = {}
    out, at = [], 0
    while at < len(text):
        cut = _BLANK.search(text, at + _PART)
        end = cut.start() if cut else len(text)
        words = text[at:end].split()
        out.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_words(words: np.ndarray, window: int) -> int:
    """Words covered by windows found twice or more; windows are told apart exactly.

    Windows get numbers by doubling: the number of 2n words comes from those of its halves.
    """
    total = len(words) - window + 1
    if total < 2:
        return 0
    found, done, width, block = None, 0, 1, words
    while True:
        if window & width:
            part = block[done : done + total]
            found = part if found is None else _renumber(found[:total], part)
            done += width
        if done == window:
            break
        block = _renumber(block[: len(block) - width], block[width:])
        width *= 2
    names, times = np.unique(found, return_counts=True)
    starts = np.flatnonzero(times[np.searchsorted(names, found)] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[starts] += 1
    edges[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(edges)))


def _renumber(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    # Numbers are below the number of words, so the pair fits 64 bits.
    _, numbers = np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)
    return numbers


def judge(text: bytes, rules: Rules) -> tuple[list[int], bytes]:
    """The figures of one document, in the order of ``FIGURES``, and its text without failing lines."""
    words = word_numbers(text)
    code_points = len(text) - int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))
    word_chars = code_points - sum(text.count(bytes([b])) for b in BLANKS)
    n_symbols = sum(text.count(bytes([b])) for b in SYMBOLS)
    repeated = repeated_words(words, rules.window)
    seen: set[bytes] = set()
    lost = {"punctuation": 0, "navigation": 0, "boilerplate": 0}
    duplicates = lines = lost_chars = 0
    kept = []
    for line in text.split(b"\n"):
        if not line.strip(BLANKS):
            kept.append(line)
            continue
        lines += 1
        duplicates += line in seen
        seen.add(line)
        rule = failing_rule(line, rules)
        if rule is None:
            kept.append(line)
            continue
        lost[rule] += 1
        lost_chars += sum(len(w.decode("utf-8", "replace")) for w in line.split())
    base_failed = len(words) < rules.min_words or 100 * repeated > rules.repeat_percent * len(words)
    keep = not base_failed and 100 * lost_chars <= rules.max_lost_percent * word_chars
    figures = [len(words), word_chars, n_symbols, duplicates, repeated, lines, *lost.values(), lost_chars]
    return [*figures, int(base_failed), int(keep)], b"\n".join(kept)


FIGURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_punctuation", "n_navigation", "n_boilerplate", "lost_chars", "base_failed", "kept",
)


def line_quality(
    docs: DataFrame,
    rules: Rules = Rules(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, ``FIGURES``, and with ``with_text`` the cleaned text.

    ``n_punctuation``, ``n_navigation`` and ``n_boilerplate`` count the lines removed by each rule,
    ``lost_chars`` the code points of their words. ``base_failed``: too few words, or too many of
    them in repeated windows. ``kept``: neither that nor too much text lost.

    A map over whole texts, nothing is shuffled; every row is judged by its own text alone, so
    copies, repeated rows and ties are judged alike. NULL and empty texts have no words: all counts
    0, ``base_failed`` true, cleaned text empty. NULL ids are kept. Extra columns are not read.
    """
    ship(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", content().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = ", ".join(f"{n} {'boolean' if n in ('base_failed', 'kept') else 'bigint'}" for n in FIGURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            figures, texts = [], []
            for text in batch["text"]:
                found, cleaned = judge(text.as_py(), rules)
                figures.append(found)
                texts.append(cleaned if with_text else None)
            columns = {"doc_id": batch["doc_id"]}
            for name, values in zip(FIGURES, zip(*figures, strict=True), strict=True):
                flag = name in ("base_failed", "kept")
                columns[name] = pa.array(map(bool, values) if flag else values, pa.bool_() if flag else pa.int64())
            if with_text:
                columns["text"] = pa.array(texts, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {kind}, {counted}" + (", text binary" if with_text else "")
    found = rows.mapInArrow(run, schema)
    return found.withColumn("text", F.col("text").cast("string")) if with_text else found


def clean(docs: DataFrame, rules: Rules = Rules(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Kept documents only: their id and their text without the failing lines."""
    found = line_quality(docs, rules, id_col=id_col, text_col=text_col, with_text=True)
    return found.where("kept").select(F.col("doc_id").alias(id_col), F.col("text").alias(text_col))
