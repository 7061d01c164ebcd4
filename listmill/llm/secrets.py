"""Secret scan: patterns, and strings that a tokenizer finds unlikely.

The token-efficiency test looks at unbroken runs of ``RUN`` characters or more, of
``LETTERS_RUN`` or more without digits. A vocabulary made from ordinary text spells such
a run in few long tokens if it is language, and in many short ones if it is random: below
``RATIO`` characters per token it is reported as ``random``. A run that passes is cut at
``/ = + - _`` and stretches of pieces that all are below the ratio are reported, so plain
words beside a random string do not hide it. Left out are digests by their form
(hexadecimal of a digest's length), UUIDs, identifiers (dates, version-like strings and
names, whose parts are letters or digits only, with fewer than ``LETTERS_RUN`` letters in
parts below the ratio), numbers, and what a pattern has already reported.

The vocabulary's ranks are read once, on the driver, from ``vocabulary``, and sent to
the executors; they are about a megabyte.

Defined cases: null and empty texts have no spans; positions are code points, ends
exclusive; repeated rows are scanned alike; no rows give no rows. Other columns play
no part.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.llm.common import chunks, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's texts were split before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

RUN = 16
LETTERS_RUN = 18
# Pieces below this length say nothing.
SHORT = 4
RATIO = 1.9

# Kinds of spans in the order in which equal starts are listed.
ASSIGN, ACCESS, HEX, RANDOM = "assign", "access", "hex", "random"
KINDS = (ASSIGN, ACCESS, HEX, RANDOM)
BASE = (ASSIGN, ACCESS, HEX)

# The patterns of the base kinds and the lengths they need.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LEAST_VALUE, _LEAST_ACCESS, _LEAST_HEX = 6, 20, 24
_WORDS = ("passw", "secret", "token", "api_key", "apikey")

_RUNS = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RUN)
# Hexadecimal lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
_DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
_ONLY_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(
    r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9])"
)
_PIECE = re.compile(r"[A-Za-z0-9]+")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns; each kind leftmost and without overlaps of its own."""
    found = []
    lower = text.lower()
    if any(word in lower for word in _WORDS):
        found += [
            (ASSIGN, m.start(), m.end())
            for m in _ASSIGN.finditer(text)
            if len(m[2]) >= _LEAST_VALUE
        ]
    if "AKIA" in text:
        found += [
            (ACCESS, m.start(), m.end())
            for m in _ACCESS.finditer(text)
            if m.end() - m.start() >= _LEAST_ACCESS
        ]
    if _longest(text) >= _LEAST_HEX:
        found += [
            (HEX, m.start(), m.end())
            for m in _HEX.finditer(text)
            if m.end() - m.start() >= _LEAST_HEX
        ]
    return found


def _longest(text: str) -> int:
    return max(map(len, text.split()), default=0)


def _is_digest(piece: str) -> bool:
    return len(piece) in _DIGEST_LENGTHS and _ONLY_HEX.fullmatch(piece) is not None


def _is_word(piece: str, tokens: int) -> bool:
    """Letters that the vocabulary spells in long tokens, or too few to tell."""
    return piece.isalpha() and (len(piece) < SHORT or len(piece) / tokens >= RATIO)


def _has_least(letters_only: bool, size: int) -> bool:
    return size >= (LETTERS_RUN if letters_only else RUN)


def random_stretches(run: str, tokens: Callable[[str], int]) -> list[tuple[int, int]]:
    """First and end place of what is random in a run: all of it, or stretches of its pieces.

    A stretch has no digest, UUID or piece in long tokens; short pieces and numbers in it
    count for nothing.
    """
    known = {m.start() + at for m in _UUID.finditer(run) for at in (0, 9, 14, 19, 24)}
    pieces = [(m.start(), m.end(), m.group()) for m in _PIECE.finditer(run)]
    known |= {start for start, _, piece in pieces if _is_digest(piece)}
    counts = [tokens(piece) for *_, piece in pieces]
    if all(piece.isdigit() or piece.isalpha() for *_, piece in pieces):
        odd = [p for (*_, p), n in zip(pieces, counts, strict=True) if not _is_word(p, n)]
        if sum(len(piece) for piece in odd if piece.isalpha()) < LETTERS_RUN:
            return []  # an identifier
    letters_only = not any(c.isdigit() for c in run)
    if not known and _has_least(letters_only, len(run)) and len(run) / tokens(run) < RATIO:
        return [(0, len(run))]
    found, first, end, size, letters_only = [], None, 0, 0, True

    def close() -> None:
        nonlocal first, size, letters_only
        if first is not None and _has_least(letters_only, size):
            found.append((first, end))
        first, size, letters_only = None, 0, True

    for (start, stop, piece), n in zip(pieces, counts, strict=True):
        if len(piece) < SHORT or piece.isdigit():
            continue
        if len(piece) / n >= RATIO or start in known:
            close()
            continue
        first = start if first is None else first
        end, size = stop, size + len(piece)
        letters_only = letters_only and piece.isalpha()
    close()
    return found


def random_spans(text: str, encoding: tiktoken.Encoding, taken: list[Span]) -> list[Span]:
    """Runs and parts of runs with few characters per token, outside the spans already taken."""
    if _longest(text) < RUN:
        return []

    def tokens(part: str) -> int:
        return len(encoding.encode_ordinary(part))

    found = []
    for m in _RUNS.finditer(text):
        for start, end in random_stretches(m.group(), tokens):
            start, end = start + m.start(), end + m.start()
            if not any(a < end and start < b for _, a, b in taken):
                found.append((RANDOM, start, end))
    return found


def secret_spans(text: str, encoding: tiktoken.Encoding) -> list[Span]:
    """All spans by start, then in the order of the kinds."""
    base = base_spans(text)
    return sorted(
        base + random_spans(text, encoding, base), key=lambda s: (s[1], KINDS.index(s[0]), s[2])
    )


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def find_secrets(documents: DataFrame, *keep: Column, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``spans``, an array of (kind, start, end), for every row."""
    ranks = documents.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    rows = documents.select(*keep, F.col("text").cast("string").alias("_text"))
    span = T.StructType().add("kind", "string").add("start", "long").add("end", "long")
    schema = rows.drop("_text").schema.add("spans", T.ArrayType(span))
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding(
            "vocabulary", pat_str=PATTERN, mergeable_ranks=ranks.value, special_tokens={}
        )
        for batch in chunks(batches, "_text"):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = [
                [{"kind": k, "start": s, "end": e} for k, s, e in secret_spans(t or "", encoding)]
                for t in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, kind)], [*batch.schema.names[:-1], "spans"]
            )

    return rows.mapInArrow(scanned, schema)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    """Spans of every document."""
    found = find_secrets(table(spark, sf_dir, "documents"), F.col("doc_id"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        count(ASSIGN).alias("n_assign"),
        count(ACCESS).alias("n_access"),
        count(HEX).alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
