"""Blocks to parents, and parents to overlapping children, by counts of tokens."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_SCHEMA = "document_id string, parent int, parent_tokens int, position int, text string, n_tokens int, ordinals array<int>, short boolean"


@dataclass(frozen=True)
class Limits:
    """Sizes in tokens; fixed values of the data model."""

    child_target: int = 192
    child_most: int = 220
    overlap: int = 24
    child_least: int = 32
    parent_target: int = 1200
    parent_most: int = 1600


@dataclass(frozen=True)
class Block:
    ordinal: int
    kind: str
    section: tuple[str, ...]
    text: str


def _slices(text: str, size: int, step: int) -> Iterator[str]:
    """Runs of size words, step apart; the last one reaches the end."""
    words = text.split()
    for i in range(0, max(len(words) - (size - step), 1), step):
        yield " ".join(words[i : i + size])


def parents(blocks: list[Block], limits: Limits) -> Iterator[list[Block]]:
    """Groups of consecutive blocks. A block beyond the most goes alone, in slices without overlap."""
    group, held = [], 0
    for b in blocks:
        n = len(b.text.split())
        starts = b.kind in ("heading", "page_break")
        turns = group and b.kind == "heading" and b.section != group[-1].section
        if group and (turns or held + n > limits.parent_most or (starts and held + n > limits.parent_target)):
            yield group
            group, held = [], 0
        if not n:  # a page break only ends groups
            continue
        if n > limits.parent_most:
            for piece in _slices(b.text, limits.parent_target, limits.parent_target):
                yield [Block(b.ordinal, b.kind, b.section, piece)]
        else:
            group, held = [*group, b], held + n
    if group:
        yield group


def pieces(block: Block, limits: Limits) -> Iterator[str]:
    """A block's text in parts of at most child_most tokens. Parts of a table begin with its two header lines while those leave room for rows."""
    size = lambda s: len(s.split())
    if size(block.text) <= limits.child_most:
        yield block.text
        return
    lines = [x for x in block.text.split("\n") if x.strip()]
    head = "\n".join(lines[:2])
    fits = block.kind == "table" and size(head) < limits.child_most and all(size(head) + size(x) <= limits.child_most for x in lines[2:]) and len(lines) > 2
    if fits:
        part, n = [], size(head)
        for x in lines[2:]:
            if part and n + size(x) > limits.child_target:
                yield "\n".join([head, *part])
                part, n = [], size(head)
            part, n = [*part, x], n + size(x)
        yield "\n".join([head, *part])
        return
    whole = block.kind in ("table", "code")
    yield from _slices(block.text, limits.child_target, limits.child_target if whole else limits.child_target - limits.overlap)


def children(group: list[Block], limits: Limits) -> Iterator[tuple[str, int, list[int]]]:
    """Text, tokens and ordinals of each child of a parent."""
    held: list[tuple[int, str]] = []
    total = 0

    def out():
        return "\n\n".join(t for _, t in held), total, sorted({o for o, _ in held})

    for b in group:
        for text in pieces(b, limits):
            n = len(text.split())
            if held and total + n > limits.child_target:
                yield out()
                held, total = [], 0
            held.append((b.ordinal, text))
            total += n
            if total >= limits.child_target:
                yield out()
                held, total = [], 0
    if held:
        yield out()


def hierarchical_chunks(block_rows: DataFrame, limits: Limits | None = None) -> DataFrame:
    """One row per child: its parent's number and size, its position in the document, text, tokens, block ordinals, and whether it is a parent's
    last one and short.

    block_rows: document_id, ordinal, block_type, section_path, text. A document's blocks meet in one task, as its text did before;
    blocks with blank or null text are skipped, but for a page break's effect on where parents end.
    """
    limits = limits or Limits()

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ordinal")
        blocks = [Block(int(o), k or "paragraph", tuple(s if s is not None else ()), t or "") for o, k, s, t in zip(rows["ordinal"], rows["block_type"], rows["section_path"], rows["text"])]
        out = []
        for p, group in enumerate(parents(blocks, limits)):
            whole = sum(len(b.text.split()) for b in group)
            own = [[key[0], p, whole, 0, *c, False] for c in children(group, limits)]
            own[-1][-1] = own[-1][5] < limits.child_least
            out += own
        for k, row in enumerate(out):
            row[3] = k
        return pd.DataFrame(out, columns=["document_id", "parent", "parent_tokens", "position", "text", "n_tokens", "ordinals", "short"])

    some = F.trim(F.translate("text", "\n\r\t", "   ")) != ""
    rows = block_rows.where(F.coalesce(some, F.lit(False)) | F.col("block_type").eqNullSafe("page_break")).select(F.col("document_id").cast("string").alias("document_id"), "ordinal", "block_type", "section_path", "text")
    return rows.groupBy("document_id").applyInPandas(pack, CHUNK_SCHEMA)
