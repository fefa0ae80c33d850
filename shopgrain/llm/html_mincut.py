"""Main text of pages by a minimum cut.

A page is a row of text blocks. A classifier gives each block a cost of being called
content and one of being boilerplate: the elements around it, words in their class and
id, its share of links, its length. These costs are the capacities from the source and to
the sink; blocks that follow each other, and those close in the document tree, are tied
by smoothness edges. The smallest cut separates content from boilerplate, so a doubtful
block goes with its surroundings.

Blocks whose own cost outweighs all their edges are decided first, which leaves the
smallest cut as it is; a maximum flow, by blocking flows, settles the others. The weights
are fixed, as no table tells content from boilerplate. Time and memory follow the length
of the page, however deep its elements or long its lists are.

Defined cases: null and empty html, and pages without content, give an empty text with
n_chars 0; character references are decoded; white space in a block becomes one blank;
unclosed elements end with their parents; repeated rows and null ids are pages of their
own; an empty table gives no rows; columns besides id, url and html are not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import Block, Element, apart, blocks

#: Weights of the classifier, in units of a doubtful block; positive is content.
KIND_WEIGHT = {0: 0.0, 1: 4.0, 2: -5.0, 3: -8.0}
CONTENT_NAME = 1.5
PARAGRAPH = 1.0
HEADING = 0.5
ITEM = -0.5
LINKS = -3.0
SHORT, SHORT_BELOW = -1.0, 25
LONG, LONG_FROM = 1.5, 80
SENTENCE = 0.5
#: Weights of the edges between neighbours, and between blocks of one parent.
NEXT = 0.4
SAME_PARENT = 0.6
#: What is less than this does not flow.
STILL = 1e-9


def content_weight(block: Block) -> float:
    """Cost of calling a block boilerplate less that of calling it content."""
    n = len(block.text)
    weight = KIND_WEIGHT[block.kind]
    if block.content and block.kind < 2:
        weight += CONTENT_NAME
    if block.tag in ("p", "blockquote", "pre"):
        weight += PARAGRAPH
    elif block.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        weight += HEADING
    elif block.tag in ("li", "td", "th", "option"):
        weight += ITEM
    weight += LINKS * block.linked / n
    weight += LONG if n >= LONG_FROM else SHORT if n < SHORT_BELOW else 0.0
    if block.text[-1] in ".!?…\"”»" and block.kind < 2:
        weight += SENTENCE
    return weight


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: neighbours in the page, and successive blocks of one parent.

    The way in the tree from one block to the next is made of elements that were opened or
    closed between them, so all of them together are as long as the page.
    """
    out = []
    last_of: dict[Element | None, int] = {}
    for i, block in enumerate(found):
        if i:
            out.append((i - 1, i, NEXT / (1 + apart(block.outer, found[i - 1].outer))))
        parent = block.parent()
        before = last_of.get(parent)
        if before is not None:
            out.append((before, i, SAME_PARENT))
        last_of[parent] = i
    return out


def smallest_cut(weights: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Sides of a smallest cut: true with the source. Doubt (weight zero, no ties) is false."""
    n = len(weights)
    weights = list(weights)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in ties:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    side: list[bool | None] = [None] * n
    check = deque(range(n))
    while check:  # a block that outweighs its edges is decided, and pulls its neighbours
        i = check.popleft()
        if side[i] is None and abs(weights[i]) >= sum(near[i].values()):
            side[i] = weights[i] > 0
            for j, w in near[i].items():
                weights[j] += w if side[i] else -w
                del near[j][i]
                check.append(j)
            near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        for i, inside in zip(rest, _reached(rest, weights, near), strict=True):
            side[i] = inside
    return side


def _reached(rest: list[int], weights: list[float], room: list[dict[int, float]]) -> list[bool]:
    """Which blocks the source still reaches when no more can flow: blocking flows over the
    levels of a search from the source, shortest ways first. `room` is used up."""
    supply = {i: weights[i] for i in rest if weights[i] > STILL}
    demand = {i: -weights[i] for i in rest if weights[i] < -STILL}
    while True:
        level = dict.fromkeys(supply, 0)
        layer, depth, ends = list(supply), 0, False
        while layer and not ends:  # up to the first level where something can flow off
            following = []
            for i in layer:
                ends = ends or i in demand
                for j, r in room[i].items():
                    if r > STILL and j not in level:
                        level[j] = depth + 1
                        following.append(j)
            if not ends:
                layer, depth = following, depth + 1
        if not ends:
            return [i in level for i in rest]
        ways: dict[int, list[int]] = {}  # where a block's flow can go on, the present one last
        for start in list(supply):
            path = [start]
            while path:
                i = path[-1]
                if level[i] == depth and i in demand:
                    flow = min(supply[start], demand[i], *(room[x][y] for x, y in zip(path, path[1:], strict=False)))
                    for left, at in ((supply, start), (demand, i)):
                        left[at] -= flow
                        if left[at] <= STILL:
                            del left[at]
                    keep = len(path)
                    for k in range(len(path) - 2, -1, -1):
                        x, y = path[k], path[k + 1]
                        room[x][y] -= flow
                        room[y][x] += flow
                        if room[x][y] <= STILL:
                            keep = k + 1
                    if start not in supply:
                        break
                    del path[keep:]
                    continue
                if i not in ways:
                    ways[i] = list(room[i]) if level[i] < depth else []
                on = ways[i]
                while on and (room[i][on[-1]] <= STILL or level.get(on[-1]) != level[i] + 1):
                    on.pop()
                if on:
                    path.append(on[-1])
                else:  # nothing flows on from here
                    level[i] = -1
                    path.pop()


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    if not found:
        return ""
    inside = smallest_cut([content_weight(b) for b in found], edges(found))
    return " ".join(b.text for b, keep in zip(found, inside, strict=True) if keep)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            texts = [main_text(html.as_py()) for html in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )


def extracted(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    rows = pages.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        F.col(f"`{html_column}`").cast("string").alias("html"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_texts, f"id {kind}, url string, text string, n_chars long")
    return out.withColumnRenamed("id", id_column).withColumnRenamed("url", url_column)
