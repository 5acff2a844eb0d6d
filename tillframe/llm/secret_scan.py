"""Secrets: three fixed expressions, and strings that compression finds new where secrets are expected.

A candidate is a run of 16 or more token characters that mixes digits with letters, or both
cases inside. It counts where a word for credentials (`SENSITIVE`) stands up to 64 code points before
it in its line. Its novelty is the number of bytes it adds when it is compressed together with
the text around it, by zstandard primed with a dictionary of identifiers, over the bytes that
random characters of its alphabet need. Other copies of the candidate are cut from the
surroundings first, so a secret does not excuse its own repetition. Words, paths and names cost
less than random strings; those at `threshold` or above are reported as kind `novel`,
whether or not a fixed expression covers them.

The dictionary holds the `entries` words of letters and underscores that most documents use,
counted over all documents, so it is at most 25 bytes times `entries` and is sent with the
task. Everything else happens inside one row, and no text is shuffled.

Defined cases: a null text counts as empty and has no spans. Places count code points, ends are
exclusive. Repeated rows are answered one by one, nulls elsewhere and repeated ids change nothing.
Words used by equally many documents enter the dictionary in order of the word. Very long
texts are searched whole, in linear time. Result columns replace input columns of the same name,
whatever their case. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tillframe.llm.common import map_batches, own_names, without_columns

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: A match of the whole run that is too short fails, so asking for the length at once finds the same.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_SHORTEST_VALUE = 6

#: Words that announce credentials. Fixed values.
SENSITIVE = re.compile(
    r"password|passwd|passphrase|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth(?!or)|bearer|credential|"
    r"signature|session|cookie|client[_ -]?id", re.IGNORECASE | re.ASCII)
_RUN = re.compile("[A-Za-z0-9+/_.~\\x80-\U0010ffff-]{16,}={0,2}")
_DIGIT, _LETTER, _SMALL, _CAPITAL = map(re.compile, ("[0-9]", "[A-Za-z]", "[a-z]", "[A-Z]"))
_REACH = 64

SECRETS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()),
                                StructField("value", StringType())]))


@dataclass(frozen=True)
class Novelty:
    """Size of the identifier dictionary, what surrounds a candidate, and the novelty that is reported."""

    entries: int = 4096
    window: int = 1000
    shortest: int = 16
    threshold: float = 1.3
    level: int = 9


def identifier_dictionary(docs: DataFrame, text: str = "text", settings: Novelty = Novelty()) -> bytes:
    """The words that most documents use, the most frequent last, where the compressor reaches them best."""
    words = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(r"(?<![A-Za-z_])[A-Za-z_]{4,24}(?![A-Za-z_])"), F.lit(0)))
    counted = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    best = counted.orderBy(F.desc("n"), "word").limit(settings.entries).collect()
    return " ".join(row.word for row in reversed(best)).encode()


def alphabet(candidate: str) -> int:
    """Size of the smallest usual alphabet that holds the candidate."""
    if re.fullmatch("[0-9]+", candidate):
        return 10
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", candidate):
        return 16
    parts = (("[a-z]", 26), ("[A-Z]", 26), ("[0-9]", 10), ("[^A-Za-z0-9]", 2))
    return sum(size for pattern, size in parts if re.search(pattern, candidate))


class Compressor:
    """Bytes of a text when the dictionary is known."""

    def __init__(self, dictionary: bytes, settings: Novelty):
        import zstandard

        options = {"level": settings.level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if len(dictionary) >= 8:  # the library takes no shorter one
            primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=settings.level)
            options["dict_data"] = primed
        self._zstd = zstandard.ZstdCompressor(**options)
        self.settings = settings

    def size(self, text: str) -> int:
        return len(self._zstd.compress(text.encode("utf-8", "surrogatepass")))

    def novelty(self, text: str, start: int, end: int) -> float:
        """Bytes that the candidate adds to its surroundings, over what random characters would add."""
        candidate, window = text[start:end], self.settings.window
        before = text[max(0, start - window):start].replace(candidate, "")
        after = text[end:end + window].replace(candidate, "")
        added = self.size(before + candidate + after) - self.size(before + after)
        return added / (len(candidate) * math.log2(max(2, alphabet(candidate))) / 8)


def base_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the fixed expressions; matches that fail are dropped and not tried again."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _SHORTEST_VALUE]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]


def mixed_characters(text: str, start: int, end: int) -> bool:
    """Whether the part has a digit and a letter, or a small letter before a capital one."""
    if _DIGIT.search(text, start, end):
        return bool(_LETTER.search(text, start, end))
    small = _SMALL.search(text, start, end)
    return bool(small and _CAPITAL.search(text, small.end(), end))


def candidates(text: str, shortest: int) -> Iterator[tuple[int, int]]:
    """Places of the strings that a credential word precedes in their line."""
    if not SENSITIVE.search(text):
        return
    for match in _RUN.finditer(text):
        found = match[0]
        if not found.isascii():
            continue
        start, end = match.start() + len(found) - len(found.lstrip(".-~")), match.start() + len(found.rstrip(".-~"))
        if end - start >= shortest and mixed_characters(text, start, end):
            reach = max(0, match.start() - _REACH)
            line = max(reach, text.rfind("\n", reach, match.start()) + 1)
            if SENSITIVE.search(text, line, match.start()):
                yield start, end


def secrets_of(text: str, compressor: Compressor) -> list[tuple[int, int, int]]:
    settings = compressor.settings
    new = [(a, 3, b) for a, b in candidates(text, settings.shortest) if compressor.novelty(text, a, b) >= settings.threshold]
    return sorted(base_secrets(text) + new)


@own_names
def find_secrets(docs: DataFrame, text: str = "text", settings: Novelty = Novelty(), dictionary: bytes | None = None) -> DataFrame:
    """The columns of `docs` with `secrets`: kind, start, end and value of each, by start and kind."""
    dictionary = identifier_dictionary(docs, text, settings) if dictionary is None else dictionary
    kept = without_columns(docs, "secrets")
    columns = [*kept, *[name for name in (text,) if name not in kept]]
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)
    schema = StructType([docs.schema[name] for name in kept]).add("secrets", SECRETS)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = Compressor(shared.value, settings)
        for batch in batches:
            found = [[{"kind": KINDS[rank], "start": a, "end": b, "value": value[a:b]} for a, rank, b in secrets_of(value, compressor)]
                     for value in (x or "" for x in batch.column(columns.index(text)).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(found, kind)], schema.names)

    return map_batches(docs.select(*[docs[f"`{name}`"] for name in columns]), scan, schema)


def span_text(secrets: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(secrets, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _is_kind(kind: str):
    return lambda secret: secret["kind"] == kind


def secret_report(docs: DataFrame) -> DataFrame:
    found = find_secrets(docs.select("doc_id", "text")).drop("text")
    counts = [F.size(F.filter("secrets", _is_kind(kind))).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    base = F.filter("secrets", lambda x: x["kind"] != "novel")
    return found.select("doc_id", *counts[:3], F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans"), counts[3])
