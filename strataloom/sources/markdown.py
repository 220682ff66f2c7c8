"""Markdown texts to blocks with the path of headings above them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

BLOCK_SCHEMA = "document_id string, title string, ordinal int, block_type string, section_path array<string>, text string"

_HEADING = re.compile(r" {0,3}(#{1,6})[ \t]+(.*?)[ \t]*#*[ \t]*$")
_FENCE = re.compile(r" {0,3}(`{3,}|~{3,})")
_RULE = re.compile(r"[ \t]*\|?[ \t]*:?-+:?[ \t]*(\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$")
_LEADS = (("list", re.compile(r"[ \t]*([-*+]|\d+[.)])[ \t]+")), ("quote", re.compile(r"[ \t]*>")))
_FIELD = re.compile(r"([A-Za-z_][\w-]*):[ \t]*(.*)$")


def frontmatter(text: str) -> tuple[dict[str, str], str]:
    """The plain `key: value` lines between a leading pair of --- lines, and the text after them; without such a pair, nothing and the text."""
    lines = text.split("\n")
    if lines[0].rstrip() != "---":
        return {}, text
    end = next((i for i, x in enumerate(lines[1:], 1) if x.rstrip() == "---"), None)
    if end is None:
        return {}, text
    found = (_FIELD.match(x) for x in lines[1:end])
    return {m[1]: m[2].strip().strip("\"'") for m in found if m}, "\n".join(lines[end + 1 :])


def _kind(lines: list[str], i: int) -> str:
    """What begins at line i."""
    if _HEADING.match(lines[i]):
        return "heading"
    if _FENCE.match(lines[i]):
        return "code"
    if "|" in lines[i] and i + 1 < len(lines) and "-" in lines[i + 1] and "|" in lines[i + 1] and _RULE.match(lines[i + 1]):
        return "table"
    return next((name for name, lead in _LEADS if lead.match(lines[i])), "paragraph")


def _end(lines: list[str], i: int, kind: str) -> int:
    """The line after the block of this kind that begins at line i."""
    if kind == "heading":
        return i + 1
    if kind == "code":
        mark = _FENCE.match(lines[i])[1]
        closing = re.compile(rf" {{0,3}}{re.escape(mark[0])}{{{len(mark)},}}[ \t]*$")
        return next((j + 1 for j in range(i + 1, len(lines)) if closing.match(lines[j])), len(lines))
    j = i + (2 if kind == "table" else 1)
    while j < len(lines) and lines[j].strip():
        if kind == "table" and "|" not in lines[j]:
            break
        if kind != "table" and _kind(lines, j) not in (kind, "paragraph"):
            break
        j += 1
    return j


def blocks_of(text: str) -> Iterator[tuple[str, list[str], str]]:
    """Kind, section path and text of each block. A heading's path holds itself; an unclosed fence runs to the end."""
    lines, path, i = text.replace("\r\n", "\n").replace("\r", "\n").split("\n"), [], 0
    while i < len(lines):
        if not lines[i].strip():
            i += 1
            continue
        kind = _kind(lines, i)
        j = _end(lines, i, kind)
        body = "\n".join(lines[i:j]).strip()
        if kind == "heading":
            mark = _HEADING.match(lines[i])
            body, level = mark[2].strip(), len(mark[1])
            path = [*(p for p in path if p[0] < level), (level, body)]
        if body:
            yield kind, [p[1] for p in path], body
        i = j


def markdown_blocks(docs: DataFrame) -> DataFrame:
    """document_id, title, ordinal, block_type, section_path, text. Docs: document_id, text; further columns are left out.

    The title is the front matter's, else the last part of document_id without its suffix. Null and blank texts have no blocks.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, text in zip(batch["document_id"], batch["text"]):
                meta, body = frontmatter((text or "").replace("\r\n", "\n"))
                title = meta.get("title") or re.sub(r"\.[^./]+$", "", (name or "").rsplit("/", 1)[-1])
                rows += [(name, title, k, *b) for k, b in enumerate(blocks_of(body))]
            yield pd.DataFrame(rows, columns=["document_id", "title", "ordinal", "block_type", "section_path", "text"])

    return docs.selectExpr("CAST(document_id AS STRING) AS document_id", "text").mapInPandas(parse, BLOCK_SCHEMA)
