"""Secret scans: fixed patterns, and strings that their surroundings cannot compress.

Beside three patterns, long strings near a sensitive word are measured: a
zstandard compressor primed with the text around the candidate and a dictionary
of identifiers tells how many bytes the candidate adds. Names, paths and
repeated strings add few; a random key adds almost all of its bytes, or as many
as the letters of its alphabet can carry. The word may stand before or after the
string, and holds for further parts and lines of the same key.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm.shared import arrays, filled

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}")
_SENSITIVE = re.compile(
    r"pass(word|wd|phrase)?\b|secret|token|api.?key|access.?key|private|credential|bearer|auth|signature|sig=|pwd|webhook",
    re.I | re.A)
# What identifiers in code and configuration are made of.
IDENTIFIERS = (
    "id key name value type user account client server host port path file config environment default request response "
    "session cookie header authorization bearer basic token access refresh secret password passwd credential private public "
    "api_key apiKey access_key accessKeyId secret_access_key client_id client_secret database username connection string "
    "http https www com org net localhost import export return function class const static void public private protected "
    "int long float double boolean true false null none self this new delete insert select update from where "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ example test sample placeholder changeme xxxxxxxx 00000000 "
    "application/json text/html charset utf-8 content-type base64 sha256 md5 uuid begin end"
)
AROUND, NEAR = 512, 48
# What may stand between two parts of one key: a dot, or a line's end with quotes and the like.
_GAP = re.compile(r"""\.|[ \t"',]*(?:\r?\n|\\)[\s"',\\]*""")
_PEM, _PEM_END = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----"), "-----END "
_PEM_LINE = re.compile(r"\\[nr]|[A-Za-z0-9+/=]+")
_PEM_HEADER = re.compile(r"^[^\n]*:[^\n]*$", re.M)
# Alphabets of fewer than 64 letters and the bits that a random letter of them carries.
_ALPHABETS = ((re.compile("[0-9]+"), math.log2(10)), (re.compile("[0-9a-f]+|[0-9A-F]+"), 4.0), (re.compile("(?:[a-z2-7]+|[A-Z2-7]+)=*"), 5.0))
# Share of those bits that a random string keeps under compression.
KEPT = 0.95


class Novelty:
    """Share of a candidate's bytes that remain after compression against its surroundings."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        import zstandard

        self.zstd, self.identifiers = zstandard, identifiers.encode()

    def __call__(self, candidate: str, before: str, after: str) -> float:
        primed = self.zstd.ZstdCompressionDict(
            self.identifiers + before.encode() + b"\n" + after.encode(), dict_type=self.zstd.DICT_TYPE_RAWCONTENT)
        packer = self.zstd.ZstdCompressor(level=3, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
        raw = candidate.encode()
        return (len(packer.compress(raw)) - len(packer.compress(b""))) / len(raw)


def least_share(candidate: str, least: float) -> float:
    """The share of bytes that a random string must add: ``least``, or what its alphabet allows."""
    bits = next((b for letters, b in _ALPHABETS if letters.fullmatch(candidate)), 6.0)
    return min(least, KEPT * bits / 8)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the three patterns, by start and then kind."""
    spans = []
    lower = text.lower()
    if any(x in lower for x in _ASSIGN_WORDS):
        spans += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(*m.span(), 2) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda x: (x[0], x[2]))


class Overlaps:
    """The spans that overlap others, which are asked for in ascending order, none overlapping another; each span is looked at once."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.spans, self.at, self.open = sorted(spans), 0, []

    def __call__(self, start: int, end: int) -> list[tuple[int, int, int]]:
        self.open = [x for x in self.open if x[1] > start]
        while self.at < len(self.spans) and self.spans[self.at][0] < end:
            if self.spans[self.at][1] > start:
                self.open.append(self.spans[self.at])
            self.at += 1
        return self.open


def key_bodies(text: str) -> Iterator[tuple[int, int]]:
    """What lies between BEGIN and the next END; a key never closed ends the search, as no later one is closed either."""
    at = 0
    while begin := _PEM.search(text, at):
        end = text.find(_PEM_END, begin.end())
        if end < 0:
            return
        yield begin.end(), end
        at = end + len(_PEM_END)


def key_lines(text: str, novelty: Novelty, least: float) -> list[tuple[int, int, int]]:
    """The lines of private keys between BEGIN and END, the short last one too; a key is measured as a whole."""
    spans = []
    if "PRIVATE KEY" not in text:
        return spans
    for start, end in key_bodies(text):
        body = _PEM_HEADER.sub(lambda x: " " * len(x[0]), text[start:end])
        lines = [x for x in _PEM_LINE.finditer(body) if x[0][0] != "\\"]
        whole = "".join(x[0] for x in lines)
        if len(whole) >= 20 and novelty(whole, text[max(0, start - AROUND):start], text[end:end + AROUND]) >= least_share(whole, least):
            spans += [(start + x.start(), start + x.end(), 3) for x in lines]
    return spans


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty, least: float) -> list[tuple[int, int, int]]:
    """Candidates near a sensitive word, or next to a part of the same key, that overlap no base span and hardly compress."""
    of_base = Overlaps(base)
    lines = [x for x in key_lines(text, novelty, least) if not of_base(x[0], x[1])]
    spans, last, said = list(lines), 0, False  # end of the part before, and whether a sensitive word holds for it
    taken = Overlaps(base + lines)
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        goes_on = said and start - last <= NEAR and _GAP.fullmatch(text, last, start)
        said = bool(goes_on or _SENSITIVE.search(text[max(0, start - NEAR):start]) or _SENSITIVE.search(text[end:end + NEAR]))
        last = end
        over = taken(start, end)
        if over:
            said, last = True, max(end, *(x[1] for x in over))
        elif said and novelty(m[0], text[max(0, start - AROUND):start], text[end:end + AROUND]) >= least_share(m[0], least):
            spans.append((start, end, 3))
    return spans


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


def masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """The text with each run of overlapping spans replaced by ``mask``."""
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def all_spans(text: str | None, novelty: Novelty, least: float) -> tuple[list, list]:
    """The base spans, and all spans by start and then kind."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(base + novel_spans(text, base, novelty, least), key=lambda x: (x[0], x[2]))


def scan_secrets(docs: DataFrame, least_novelty: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, n_assign, n_access, n_hex, n_novel, base_sha256, spans.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then in
    the order of ``KINDS``; ``base_sha256`` is the hash of that list without the
    novel spans. A null text counts as empty: no spans. A null id is kept,
    repeated rows each get a row, other columns are ignored, an empty table
    gives no rows.
    """
    key = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in filled(batches):
            rows = []
            for text in arrays(batch, text_col):
                base, spans = all_spans(text, novelty, least_novelty)
                count = [sum(x[2] == k for x in spans) for k in range(4)]
                rows.append((*count, hashlib.sha256(spelled(base).encode()).hexdigest(), spelled(spans)))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])], names=names)

    return docs.select(id_col, text_col).mapInArrow(
        scan, f"`{id_col}` {key}, n_assign bigint, n_access bigint, n_hex bigint, n_novel bigint, base_sha256 string, spans string")


def mask_secrets(docs: DataFrame, least_novelty: float = 0.75, mask: str = "[secret]", text_col: str = "text",
                 length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span that ``scan_secrets`` finds replaced by ``mask``.

    All rows and columns stay; ``length_col``, if there, is the new length of the
    texts that changed. Null and empty texts stay as they are.
    """
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in filled(batches):
            columns = list(batch.columns)
            texts = arrays(batch, text_col)
            lengths = columns[length].to_pylist() if length is not None else None
            for k, text in enumerate(texts):
                if spans := all_spans(text, novelty, least_novelty)[1]:
                    texts[k] = masked(text, spans, mask)
                    if lengths:
                        lengths[k] = len(texts[k])
            columns[at] = pa.array(texts, columns[at].type)
            if lengths:
                columns[length] = pa.array(lengths, columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(replace, docs.schema)
