"""Secret scan: fixed patterns plus dictionary-primed zstandard novelty (op 10).

Base kinds ``assign``, ``access`` and ``hex`` are the fixed patterns below.
The method then looks at every other run of 16 or more token characters that
stands in a sensitive context (a credential word shortly before it, alone or
inside a longer identifier): a zstandard compressor primed with a dictionary of
common identifiers compresses the surrounding text alone and with the candidate
put between its halves; the marginal bytes per character say how novel the
string is. Words, paths and identifiers repeat the dictionary or the context and
cost little; random keys cost close to their entropy. Incompressible candidates
are reported as ``novel``.

Runs of letters only or digits only need a sharper measure, as identifiers and
words are such runs too: their lower-case form is compressed in short pieces
against a larger word list together with the surroundings (:func:`plain_novelty`).
Names of unlisted words (other languages, say) can still count as novel.

Work is one narrow pass over the documents, Arrow batches in Python; nothing
is shuffled, so no key can be hot and a lost task is simply run again. Quick
substring tests skip patterns that cannot match; texts are scanned whole.

Edge cases: null or empty text has no spans; offsets are code points, end
exclusive; repeated rows repeat their result; null ids stay null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package
from .common_words import WORDS

KINDS = ("assign", "access", "hex", "novel")

# Fixed patterns of the base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Words that make the text after them sensitive.
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|(?!age|eng|ion|iv))|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key"
    r"|auth(?:orization|(?!or(?!i[sz])))"
    r"|bearer|credential|signature|session[_-]?id|client[_-]?id|(?:encryption|signing)[_-]?key)s?", re.I | re.A)
_CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "signature", "session", "client")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~-]{16,}")
#: Rest of the identifier that a credential word is part of, and what leads from there to its value.
_NAME = re.compile(r"[A-Za-z0-9_-]*")
_ASSIGNED = re.compile(r"""["']?\x20*:|["']?\x20+=|=+["']?(?=[A-Za-z0-9+/_~-])""")

#: Identifiers and phrases of ordinary code and configuration: the dictionary.
DICTIONARY = " ".join("""
password passwd passphrase secret token api_key apikey access_key private_key public_key authorization bearer
credentials signature session_id client_id client_secret username user_id account hostname localhost database
connection config configuration settings environment production development staging example placeholder changeme
your_api_key_here your-secret-token insert_token_here xxxxxxxxxxxxxxxx 1234567890 0123456789 abcdefghijklmnopqrstuvwxyz
ABCDEFGHIJKLMNOPQRSTUVWXYZ qwertyuiop administrator function return import class public static void string
integer boolean default require include module export const undefined null true false request response header
content-type application/json text/html https://www.example.com/index.html /usr/local/bin/ /var/log/ /home/user/
version 2024-01-01T00:00:00Z license copyright permission distributed without warranty
""".split()).encode()


@dataclass(frozen=True)
class NoveltyRule:
    """Bounds of the novelty method."""

    reach: int = 48            # a credential word ends at most this far before the candidate
    around: int = 160          # characters of context on either side
    min_ratio: float = 0.60    # marginal compressed bytes per character
    min_plain: float = 0.95    # the same for letters only or digits only, by the word list
    level: int = 9
    extra_words: tuple[str, ...] = field(default=())  # project identifiers to prime with


@lru_cache(maxsize=8)
def _compressor(rule: NoveltyRule) -> zstandard.ZstdCompressor:
    primed = " ".join(rule.extra_words).encode() + DICTIONARY
    data = zstandard.ZstdCompressionDict(primed, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=rule.level, dict_data=data, write_content_size=False, write_checksum=False)


def novelty(text: str, start: int, end: int, rule: NoveltyRule) -> float:
    """Marginal compressed bytes per character of text[start:end] in its surroundings."""
    z = _compressor(rule)
    before, after = text[max(0, start - rule.around): start].encode(), text[end: end + rule.around].encode()
    piece = text[start:end].encode()
    return (len(z.compress(before + after + piece)) - len(z.compress(before + after))) / len(piece)


#: Text that the dictionary holds: with it first, a piece is never stored raw as a whole.
_LEAD = DICTIONARY.lower()[:80]
#: Characters per piece; the literals of longer ones would be Huffman coded.
_PIECE = 48
_PLAIN = zstandard.ZstdCompressionParameters(
    window_log=17, chain_log=16, hash_log=16, search_log=6, min_match=4, target_length=32,
    strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=False, write_checksum=False)


def plain_novelty(text: str, start: int, end: int, rule: NoveltyRule) -> float:
    """Compressed bytes per character of text[start:end], case folded, given its surroundings and the word list."""
    around = text[max(0, start - rule.around): start] + " " + text[end: end + rule.around]
    known = " ".join((*rule.extra_words, *WORDS, "")).lower().encode() + DICTIONARY.lower() + b" " + around.lower().encode()
    z = zstandard.ZstdCompressor(compression_params=_PLAIN, dict_data=zstandard.ZstdCompressionDict(
        known, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    piece, alone = text[start:end].lower().encode(), len(z.compress(_LEAD))
    return sum(len(z.compress(_LEAD + piece[i: i + _PIECE])) - alone for i in range(0, len(piece), _PIECE)) / len(piece)


def is_novel(text: str, start: int, end: int, rule: NoveltyRule) -> bool:
    """Whether a candidate reaches the bound of its kind."""
    word = text[start:end]
    if any(x.isdigit() for x in word) and any(x.isalpha() for x in word):
        return novelty(text, start, end, rule) >= rule.min_ratio
    return plain_novelty(text, start, end, rule) >= rule.min_plain


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the fixed patterns, in order."""
    spans = []
    if any(w in low for w in _ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def novel_spans(text: str, low: str, base: list[tuple[int, int, int]], rule: NoveltyRule) -> list[tuple[int, int, int]]:
    """Incompressible candidates in sensitive context that no base span touches."""
    if not any(h in low for h in _CONTEXT_HINTS):
        return []
    found, seen, name_end, value, ahead = [], -1, -1, None, None
    for c in CONTEXT.finditer(text):
        if c.end() > name_end:
            name_end = _NAME.match(text, c.end()).end()
            value = _ASSIGNED.match(text, name_end)
        begin = value.end() if value else c.end()
        at = max(begin, seen)
        while True:
            if ahead is None or ahead.start() < at:
                ahead = CANDIDATE.search(text, at)
            if ahead is None:
                return found
            m = ahead
            if m.start() - begin > rule.reach:
                break
            at = seen = m.end()
            if any(s < m.end() and m.start() < e for s, _, e in base):
                continue
            if is_novel(text, m.start(), m.end(), rule):
                found.append((m.start(), 3, m.end()))
    return found


def _scan(rule: NoveltyRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                low = text.lower()
                base = base_spans(text, low)
                out.append(base + novel_spans(text, low, base, rule))
            yield pa.record_batch(
                [batch.column(0), pa.array(
                    [[{"start": s, "kind": k, "end": e} for s, k, e in sorted(r)] for r in out],
                    pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])))],
                names=["doc_id", "found"])
    return run


def secret_spans(docs: DataFrame, rule: NoveltyRule = NoveltyRule()) -> DataFrame:
    """One row per input row: doc_id, found (start, kind index into ``KINDS``, end), by start then kind."""
    ship_package(docs.sparkSession)
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return table.mapInArrow(_scan(rule), "doc_id long, found array<struct<start:long,kind:int,end:long>>")


def secret_report(docs: DataFrame, rule: NoveltyRule = NoveltyRule()) -> DataFrame:
    """Counts per base kind, digest of the base spans and all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(k: int):
        return F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")

    return secret_spans(docs, rule).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.filter("found", lambda s: s["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        listed("found").alias("spans"), count(3).alias("n_novel"))


def digest_of(spans: list[tuple[int, int, int]]) -> str:
    """The report's digest of base spans, for checks outside Spark."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans)).encode()).hexdigest()
