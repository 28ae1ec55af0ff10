"""Secret scan: fixed patterns, and strings in a sensitive context that a primed compressor finds new.

A candidate is a run of at least ``SHORTEST`` key-like characters outside the fixed patterns' spans with a sensitive word in the ``NEAR`` characters
before it on its line, in the last ``NEAR`` of the nearest line above that is not blank, or in the header of the BEGIN/END block around it. Its novelty is the number of bytes that it adds to the compressed size of the text around it, with a zstandard dictionary of code words and
identifiers; names and repeated strings add little. Candidates that add ``NOVEL`` bytes a character or more are reported as ``novel``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.store import texts

SHORTEST, NOVEL = 16, 0.62
BEFORE, AFTER, NEAR = 512, 256, 256
KINDS = ("assign", "access", "hex", "novel")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
_SENSITIVE = re.compile(r"key|secret|token|passw|passphrase|pwd|auth|bearer|credential|private|signature", re.IGNORECASE | re.ASCII)
_ABOVE = re.compile(_SENSITIVE.pattern.replace("bearer|", ""), _SENSITIVE.flags)  #: for the line above, without ``bearer``
_BLOCK = re.compile(r"-----BEGIN ([^\n-]*)-----(.*?)(?:-----END|\Z)", re.DOTALL)
#: Words of code and names of settings; strings made of these are not new.
_CODE = """import from return class public private static final void string boolean integer float double const function lambda yield async await
self this null None true false True False else elif while for range len print except raise finally default switch case break continue
client server request response session header cookie user username account email address host port path file folder config configuration settings option
environment variable value values index number count total result status message error warning debug info logger handler manager factory service
controller repository provider builder context element component database connection cursor query table column schema select insert update delete where
api_key apiKey API_KEY access_key accessKey ACCESS_KEY secret_key secretKey SECRET_KEY auth_token authToken AUTH_TOKEN access_token accessToken refresh_token
client_id client_secret private_key public_key password PASSWORD passwd credential credentials authorization Authorization Bearer signature certificate
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef xxxxxxxxxxxxxxxxxxxxxxxx 00000000000000000000 example placeholder changeme
https://www.example.com/index.html http://localhost:8080/api/v1/ application/json text/html charset=utf-8 Content-Type User-Agent""".encode()


class Novelty:
    """Marginal compressed size with the dictionary of code words."""

    def __init__(self) -> None:
        self.pack = zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(_CODE, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False).compress

    def __call__(self, text: str, start: int, end: int) -> float:
        """Bytes per character that ``text[start:end]`` adds to the text around it."""
        before, after = text[max(0, start - BEFORE) : start].encode(), text[end : end + AFTER].encode()
        return (len(self.pack(after + before + text[start:end].encode())) - len(self.pack(after + before))) / (end - start)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, number of the kind and end of the fixed patterns' matches, in order of start and kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _context(text: str, a: int, blocks: list[tuple[int, int]], above: re.Pattern) -> bool:
    """Whether a sensitive word stands before ``a`` on its line, on the line above or in the header of a block."""
    start = text.rfind("\n", 0, a) + 1
    if _SENSITIVE.search(text, max(start, a - NEAR), a) or any(s <= a < e for s, e in blocks):
        return True
    end = start
    while end and text[end - 1].isspace():
        end -= 1
    return above.search(text, max(text.rfind("\n", 0, end) + 1, end - NEAR), end) is not None


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty, bearer_above: bool = False) -> list[tuple[int, int, int]]:
    found, above = [], _SENSITIVE if bearer_above else _ABOVE
    blocks = [m.span(2) for m in _BLOCK.finditer(text) if _SENSITIVE.search(m[1])]
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        if _context(text, a, blocks, above) and not any(s < b and a < e for s, _, e in base) and novelty(text, a, b) >= NOVEL:
            found.append((a, 3, b))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches: Iterator[pa.RecordBatch], bearer_above: bool) -> Iterator[pa.RecordBatch]:
    novelty, names = Novelty(), ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part, rows = batch.slice(at, 512), []
            for text in part.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                new = novel_spans(text, base, novelty, bearer_above)
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((*n, len(new), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + new))))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array([r[k] for r in rows], pa.int64() if k < 4 else pa.string()) for k in range(6))], names)


def secrets(docs: DataFrame, bearer_above: bool = False) -> DataFrame:
    """Secrets of every whole text: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``n_novel``, ``base_sha256``, ``spans``.

    Spans are ``kind:start:end`` in code points, in order of start and then kind, joined by commas. ``assign`` spans the whole
    assignment. Null or empty text: no spans. One row per input row, repeated and null ids included; no rows for an empty table. A text's length
    is not limited; each candidate is measured against a bounded surrounding. ``bearer_above``: the word bearer on the line above counts as well
    (on in the query and in ``without_secrets``).
    """
    return texts(docs).mapInArrow(lambda batches: _scan(batches, bearer_above), "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by ``[kind]``; overlapping spans are replaced together under the first one's kind.

    ``n_chars``, where there is such a column, is set to the new length of a changed text. Other columns stay.
    """
    at = docs.columns.index("text")

    def mask(batches):
        novelty = Novelty()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                out = []
                for text in part.column(at):
                    text = text.as_py()
                    spans = base_spans(text) if text else []
                    spans = sorted(spans + novel_spans(text, spans, novelty, True)) if text else []
                    pieces, end = [], 0
                    for a, k, b in spans:
                        if a >= end:
                            pieces += [text[end:a], f"[{KINDS[k]}]"]
                        end = max(end, b)
                    out.append(text if text is None else "".join([*pieces, text[end:]]))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if k == at else part.column(k) for k in range(part.num_columns)], part.schema.names)

    out = docs.mapInArrow(mask, docs.schema)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else out
