"""Secrets in texts: patterns, and random strings that a tokenizer encodes poorly.

A vocabulary of frequent character sequences spends few tokens on anything that resembles
language or code and many on random strings. Candidates are long runs of key characters;
those with few characters per token are reported, unless they are digests or identifiers of
a known form. In other runs their parts between separators are tested.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import partial
from itertools import accumulate

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from tallybook.llm.shared import per_batch, require_columns

#: Kinds of spans in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{20,}")

#: Runs that are no secrets: digests by their length, UUIDs, numbers and dates, and words of one
#: case with their separators, such as host, path and constant names.
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = frozenset({32, 40, 48, 56, 64, 96, 128})
IDENTIFIER = re.compile(
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|[0-9TZ+/_=.-]+|[a-z+/_=.-]+|[A-Z+/_=.-]+"
)
#: Parts of a run; a UUID is one.
PART = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[A-Za-z0-9]+")
#: Characters of a run, and of a piece of a key that its own separators cut, at least.
SHORTEST, PIECE = 20, 4


@dataclass(frozen=True)
class SecretScan:
    """Parameters of the scan.

    vocabulary: file of base64 tokens and ranks, readable on every executor.
    pattern: how the vocabulary splits text before merging.
    max_chars_per_token: a run below this ratio counts as random.
    """

    vocabulary: str
    pattern: str
    max_chars_per_token: float = 1.9
    min_assigned: int = 6
    min_access: int = 20


def load_encoding(vocabulary: str, pattern: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


def base_spans(text: str, scan: SecretScan) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, in code points."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= scan.min_assigned
        ]
    found += [
        (m.start(), 1, m.end())
        for m in ACCESS.finditer(text)
        if m.end() - m.start() >= scan.min_access
    ]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_spans(
    text: str, known: list[tuple[int, int, int]], scan: SecretScan, encoding: tiktoken.Encoding
) -> list[tuple[int, int, int]]:
    """Runs of key characters with few characters per token, outside the known spans.

    Of a run with more, as behind a path or a host, its parts are tested and reported.
    """
    found = []
    known = sorted(known)
    starts = [s for s, _, _ in known]
    # The end of all spans up to each one.
    ends = list(accumulate((e for _, _, e in known), max))

    def free(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return not before or ends[before - 1] <= start

    for match in RUN.finditer(text):
        run = match[0].strip(".=-_/+")
        if len(run) < SHORTEST or _is_digest(run):
            continue
        start = match.start() + match[0].find(run)
        end = start + len(run)
        # Words of one case have separators; without any, the ratio decides.
        if run.isalpha() or not IDENTIFIER.fullmatch(run):
            if free(start, end) and _poorly_encoded(run, scan, encoding):
                found.append((start, 3, end))
                continue
        for a, b in _random_parts(run, scan, encoding):
            if free(start + a, start + b):
                found.append((start + a, 3, start + b))
    return found


def _is_digest(run: str) -> bool:
    return len(run) in DIGEST_LENGTHS and DIGEST.fullmatch(run) is not None


def _poorly_encoded(run: str, scan: SecretScan, encoding: tiktoken.Encoding) -> bool:
    return len(run) < scan.max_chars_per_token * len(encoding.encode_ordinary(run))


def _random_parts(run: str, scan: SecretScan, encoding: tiktoken.Encoding) -> list[tuple[int, int]]:
    """(start, end) of parts that are random or hold a random window, and of pieces that make one key."""
    found: list[tuple[int, int]] = []
    pieces: list[tuple[int, int]] = []

    def end() -> None:
        if pieces and pieces[-1][1] - pieces[0][0] >= SHORTEST:
            found.append((pieces[0][0], pieces[-1][1]))
        pieces.clear()

    for match in PART.finditer(run):
        part, (a, b) = match[0], match.span()
        known = "-" in part or part.isdigit() or IDENTIFIER.fullmatch(part) and not part.isalpha()
        if len(part) < PIECE or known or _is_digest(part):
            end()
        elif len(part) >= SHORTEST and _random_window(part, scan, encoding):
            # Neighbours of a long part may be names, so it stands alone.
            end()
            found.append((a, b))
        elif _mixed(part) and _poorly_encoded(part, scan, encoding):
            if pieces and a - pieces[-1][1] > 1:
                end()
            pieces.append((a, b))
        else:
            end()
    end()
    return found


def _mixed(part: str) -> bool:
    return any(map(str.isdigit, part)) + any(map(str.islower, part)) + any(map(str.isupper, part)) > 1


def _random_window(part: str, scan: SecretScan, encoding: tiktoken.Encoding) -> bool:
    """Whether the part, or a window of tokens with enough characters, is poorly encoded."""
    lengths = [len(token) for token in encoding.decode_tokens_bytes(encoding.encode_ordinary(part))]
    if len(part) < scan.max_chars_per_token * len(lengths):
        return True
    first = chars = 0
    for last, length in enumerate(lengths):
        chars += length
        while chars - lengths[first] >= SHORTEST:
            chars -= lengths[first]
            first += 1
        if chars >= SHORTEST and chars < scan.max_chars_per_token * (last - first + 1):
            return True
    return False


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SCHEMA = "n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, " \
    "base_sha256 string, spans string, values array<string>"


def _scan_batch(batch: pa.RecordBatch, scan: SecretScan, encoding: list) -> pa.RecordBatch:
    if not encoding:
        encoding.append(load_encoding(scan.vocabulary, scan.pattern))
    counts: list[list[int]] = [[], [], [], []]
    digests, spans, values = [], [], []
    for text in batch.column("text").to_pylist():
        text = text or ""
        base = base_spans(text, scan)
        both = sorted(base + random_spans(text, base, scan, encoding[0]))
        for kind in range(4):
            counts[kind].append(sum(span[1] == kind for span in both))
        digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
        spans.append(listed(both))
        values.append([text[start:end] for start, _, end in both])
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            *(pa.array(column, pa.int64()) for column in counts),
            pa.array(digests, pa.string()),
            pa.array(spans, pa.string()),
            pa.array(values, pa.list_(pa.string())),
        ],
        names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans",
               "values"],
    )


def find_secrets(docs: DataFrame, scan: SecretScan) -> DataFrame:
    """One row per document: counts by kind, the spans and the matched strings.

    Whole texts are scanned where they are read; nothing is shuffled. A null text counts as
    empty, null or repeated ids and repeated rows give a row each, an empty table gives no
    rows, and other columns are ignored. Spans are half-open, in code points, ordered by
    start and then by kind.
    """
    require_columns(docs, "doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        per_batch(partial(_scan_batch, scan=scan, encoding=[])), f"doc_id {id_type}, {SCHEMA}"
    )
