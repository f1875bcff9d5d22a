"""Secret scan: keyword automaton first, anchored expressions only at its hits, checksums last.

An Aho-Corasick automaton finds all keywords of a text in one pass; runs of hexadecimal digits, which
have no keyword, are found by a vectorised run test. An expression is tried only where a hit begins,
never searched for through the text. Kinds that carry a checksum or structure of their own are
kept only if that holds.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lamina.llm.blocks import blocks, flat

# The kinds, their keywords and expressions.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
EXTRA = {
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")),
    "npm": (("npm_",), re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")),
    "jwt": (("eyJ",), re.compile(r"(eyJ[0-9A-Za-z_-]{8,}+)\.eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{16,}")),
    "slack": (("xoxb-", "xoxp-", "xoxa-", "xoxr-"), re.compile(r"xox[bpar]-[0-9]{8,}-[0-9A-Za-z-]{16,}")),
    "private": (("-----BEGIN ",), re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[0-9A-Za-z+/=\s]{32,}-----END [A-Z ]{0,30}PRIVATE KEY-----")),
}
KINDS = (*BASE_KINDS, *EXTRA)
# What all starts inside one run of these characters have in common: if the first fails, so do the others.
RUNS = {"jwt": re.compile(r"eyJ[0-9A-Za-z_-]*+")}
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

HEX_BYTES = np.zeros(256, bool)
HEX_BYTES[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = True


def crc62(content: str) -> str:
    """CRC-32 of the text as six base-62 digits, the checksum inside GitHub and npm tokens."""
    value, digits = zlib.crc32(content.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def is_header(part: str) -> bool:
    """Whether a part decodes to a JSON object naming its algorithm, as the head of a JWT does."""
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, TypeError, binascii.Error, RecursionError):
        return False


CHECKS = {
    "github": lambda m: crc62(m[1]) == m[2],
    "npm": lambda m: crc62(m[1]) == m[2],
    "jwt": lambda m: is_header(m[1]),
}


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """All keywords in lower case; the expressions decide about case."""
    words: dict[str, list[str]] = {}
    for word in ASSIGN_WORDS:
        words.setdefault(word, []).append("assign")
    words.setdefault("akia", []).append("access")
    for kind, (starts, _) in EXTRA.items():
        for start in starts:
            words.setdefault(start.lower(), []).append(kind)
    found = ahocorasick.Automaton()
    for word, kinds in words.items():
        found.add_word(word, (len(word), kinds))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """A-Z in lower case, every other character unchanged, so places stay the same."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def anchored(text: str, starts: Iterable[int], pattern: re.Pattern, run: re.Pattern | None = None) -> Iterator[re.Match]:
    """Leftmost non-overlapping matches; ``starts`` ascend and hold every place one can begin.

    A match takes up its characters whether or not a later check keeps it. A start that fails takes
    up its ``run``, if there is one, so that a run full of starts is read once and not once per start.
    """
    free = 0
    for start in starts:
        if start < free:
            continue
        if match := pattern.match(text, start):
            free = match.end()
            yield match
        elif run and (same := run.match(text, start)):
            free = same.end()


def hex_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, byte place) of every place that begins 16 hexadecimal bytes in one document."""
    inside = HEX_BYTES[data]
    for step in (1, 2, 4, 8):
        inside = inside[:-step] & inside[step:] if len(inside) > step else inside[:0]
    places = np.flatnonzero(inside)
    doc = np.searchsorted(offsets, places, side="right") - 1
    whole = places + LEAST_HEX <= offsets[doc + 1]
    doc, places = doc[whole], places[whole] - offsets[doc[whole]]
    return doc, places


def scan(text: str, hex_places: Iterable[int]) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind as listed."""
    hits: dict[str, list[int]] = {}
    for last, (length, kinds) in automaton().iter(lowered(text)):
        for kind in kinds:
            hits.setdefault(kind, []).append(last + 1 - length)
    spans = []
    for kind, starts in hits.items():
        starts.sort()
        if kind == "assign":
            spans += [(*m.span(), kind) for m in anchored(text, starts, ASSIGN) if len(m[1]) >= LEAST_ASSIGN]
        elif kind == "access":
            spans += [(*m.span(), kind) for m in anchored(text, starts, ACCESS) if len(m[0]) >= LEAST_ACCESS]
        else:
            check = CHECKS.get(kind, bool)
            spans += [(*m.span(), kind) for m in anchored(text, starts, EXTRA[kind][1], RUNS.get(kind)) if check(m)]
    spans += [(*m.span(), "hex") for m in anchored(text, hex_places, HEX)]
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2])))


def code_points(content: bytes, places: np.ndarray) -> list[int]:
    """Byte places within UTF-8 as code point places."""
    continued = np.cumsum((np.frombuffer(content, np.uint8) & 0xC0) == 0x80)
    return (places - continued[places]).tolist()


def block_spans(texts: pa.Array) -> list[list[tuple[int, int, str]]]:
    data, offsets = flat(texts)
    doc, places = hex_runs(data, offsets)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    found = []
    for k, text in enumerate(texts.to_pylist()):
        near = places[edges[k] : edges[k + 1]]
        found.append(scan(text or "", code_points((text or "").encode(), near) if len(near) else ()))
    return found


def scan_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<start, end, kind, content>>), row by row, no shuffle.

    Null and empty texts have no spans; null doc_ids and repeated rows are kept as they are; other
    columns are ignored.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("content", pa.string())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = block.column("text").to_pylist()
            spans = [
                [{"start": a, "end": b, "kind": c, "content": text[a:b]} for a, b, c in listed]
                for text, listed in zip(texts, block_spans(block.column("text")))
            ]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "cast(text AS string) AS text").mapInArrow(
        run, "doc_id long, spans array<struct<start: long, end: long, kind: string, content: string>>"
    )


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) from :func:`scan_documents`."""
    spans = "transform(spans, s -> concat_ws(':', s.kind, s.start, s.end))"
    base = "transform(filter(spans, s -> s.kind IN ('assign', 'access', 'hex')), s -> concat_ws(':', s.kind, s.start, s.end))"
    count = "cast(size(filter(spans, s -> s.kind = '{0}')) AS long) AS n_{0}"
    return scan_documents(docs).selectExpr(
        "doc_id", *(count.format(kind) for kind in BASE_KINDS),
        f"sha2(array_join({base}, ','), 256) AS base_sha256", f"array_join({spans}, ',') AS spans",
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The table with every secret in ``text`` replaced and ``n_chars`` following; all rows stay.

    Overlapping spans are replaced together by one mark. Null texts stay null.
    """
    columns = [c for c in docs.columns if c in ("text", "n_chars")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = block.column("text").to_pylist()
            changed = {}
            for k, spans in enumerate(block_spans(block.column("text"))):
                if spans:
                    changed[k] = _replaced(texts[k], spans, mark)
            if changed:
                arrays = {"text": pa.array([changed.get(k, t) for k, t in enumerate(texts)], block.column("text").type)}
                if "n_chars" in columns:
                    sizes = block.column("n_chars").to_pylist()
                    arrays["n_chars"] = pa.array([len(changed[k]) if k in changed else n for k, n in enumerate(sizes)], block.column("n_chars").type)
                block = pa.RecordBatch.from_arrays(
                    [arrays.get(name, block.column(name)) for name in block.schema.names], block.schema.names
                )
            yield block

    return docs.mapInArrow(run, docs.schema)


def _replaced(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    kept, free = [], 0
    for start, end, _ in spans:
        if start >= free:
            kept += [text[free:start], mark]
        free = max(free, end)
    return "".join(kept) + text[free:]


def base_digest(spans: list[tuple[int, int, str]]) -> str:
    """The digest of the base kinds of one text, for checks."""
    return hashlib.sha256(written([s for s in spans if s[2] in BASE_KINDS]).encode()).hexdigest()
