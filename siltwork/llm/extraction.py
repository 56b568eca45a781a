"""A page's main text by minimum-cut labelling.

A page is cut into blocks (``blocks``). A logistic classifier gives each block its log odds to be of the article, from
the shape of its text (words, links, punctuation, digits, capitals), and the markup adds what it says of the block's
place (article, navigation, footer, classes and ids, headings such as that of the comments). These are the capacities to
the terminals: what it costs to call the block content or boilerplate. Edges make neighbours that differ costly: blocks
that follow each other, less the farther they are apart in the document, and blocks with the containers that hold them,
containers with theirs. The least cut (``mincut``) is the labelling.

The weights of the text's shape are learned from the pages themselves: of at most ``TEACHING_PAGES`` pages, drawn by a
hash, at most ``TEACHING_BLOCKS`` blocks each whose markup is plain (in an article, or in navigation and the like) are
the examples; the learned weights are held near given ones, which alone stand if no page teaches. The blocks' markup
never is a feature there.

A null or empty html gives an empty text, so does a page without blocks. Repeated rows are rows of their own; a null id
or url stays null. Character references are decoded once. All white space counts, non-breaking spaces too. Long pages are
read whole. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm.blocks import HEADINGS, Block, Page, read
from siltwork.llm.mincut import labels

#: Pages, and blocks of each, that teach at most.
TEACHING_PAGES, TEACHING_BLOCKS = 2000, 64
#: Weights of: one, log of words, share of linked text, punctuation a word, a sentence's end, digits, capitals.
GIVEN = np.array([-2.2, 0.9, -4.0, 4.0, 1.2, -2.0, -1.0])
#: Share of the evidence that the given weights are.
HELD = 0.3
#: What markup adds to the log odds: places around the article, in it, what is not shown, headings, items of lists.
AROUND, INSIDE, UNSEEN, HEADING, ITEM = -14.0, 6.0, -20.0, 0.8, -0.4
#: Costs of labels that differ: of blocks in a row in one container, of a block and its container, of a container and its own.
IN_A_ROW, IN_CONTAINER, NESTED = 1.0, 0.5, 0.3
#: An edge that follows a heading counts so often.
LED = 2
SCALE = 1000

_MARK, _DIGIT, _CAPITAL = re.compile("[,.;:!?。，、]"), re.compile("[0-9]"), re.compile("(?<![^ ])[A-Z\u00c0-\u00de\u0391-\u03a9\u0410-\u042f]")


def shape(text: str, linked: int) -> list[float]:
    """The features of a block's text."""
    words = text.count(" ") + 1
    marks, digits, capitals = (len(x.findall(text)) for x in (_MARK, _DIGIT, _CAPITAL))
    return [1.0, math.log1p(words), linked / len(text), min(marks / words, 1.0), float(text[-1] in ".!?…。\"'»”)"), digits / len(text), capitals / words]


def log_odds(block: Block, weights: list[float]) -> float:
    # Text alone never outweighs plain markup.
    out = max(-5.0, min(5.0, math.sumprod(weights, shape(block.text, block.linked))))
    if block.hidden:
        return out + UNSEEN
    out += AROUND if block.around else INSIDE if block.inside else 0.0
    return out + (HEADING if block.tag in HEADINGS else ITEM if block.tag == "li" else 0.0)


def graph(page: Page, weights: np.ndarray) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Terminals and edges: blocks first, then containers."""
    n, blocks = len(page.blocks), page.blocks
    weights = [float(w) for w in weights]
    terminals = [round(SCALE * log_odds(b, weights)) for b in blocks] + [0] * len(page.parents)
    edges = []
    for i, b in enumerate(blocks):
        edges.append((i, n + b.node, round(SCALE * IN_CONTAINER)))
        if i:
            hops = 0 if blocks[i - 1].node == b.node else 1 + abs(blocks[i - 1].depth - b.depth)
            led = LED if blocks[i - 1].tag in HEADINGS else 1
            edges.append((i - 1, i, round(SCALE * IN_A_ROW * led / (1 + hops))))
    edges += [(n + c, n + p, round(SCALE * NESTED)) for c, p in enumerate(page.parents) if p >= 0]
    return terminals, edges


def main_text(page: str, weights: np.ndarray = GIVEN) -> str:
    """The blocks that the least cut calls content, joined by spaces."""
    found = read(page)
    chosen = labels(*graph(found, weights)) if found.blocks else []
    return " ".join(b.text for b, keep in zip(found.blocks, chosen, strict=False) if keep)


def examples(page: str, most: int = TEACHING_BLOCKS) -> list[list[float]]:
    """Features and label of blocks whose markup is plain; of more than ``most`` evenly spaced ones."""
    plain = [b for b in read(page).blocks if not b.hidden and b.around != b.inside]
    step = -(-len(plain) // most) or 1
    return [[*shape(b.text, b.linked), float(b.inside)] for b in plain[::step]]


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Logistic weights by Newton's steps, each kind of example counting half, held near the given ones."""
    w = GIVEN.copy()
    if not (0 < y.sum() < len(y)):
        return w
    mass = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (mass * (y - p)) - HELD * 0.1 * (w - GIVEN)
        curve = (x * (mass * p * (1 - p))[:, None]).T @ x + HELD * 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def learn(pages: DataFrame, *, pages_most: int = TEACHING_PAGES) -> np.ndarray:
    """Weights from a bounded sample of pages (html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [e for page in batch.column(0).to_pylist() for e in examples(page)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], names=["e"])

    # Only hashes are ranked; then the pages up to the last of the first ones are read, equal pages once.
    hashed = pages.where(F.col("html").isNotNull()).select("html", F.xxhash64("html").alias("h"))
    last = hashed.select("h").distinct().orderBy("h").limit(pages_most).agg(F.max("h")).first()[0]
    if last is None:
        return GIVEN
    drawn = hashed.where(F.col("h") <= last).dropDuplicates(["h"]).orderBy("h").select("html")
    found = drawn.mapInArrow(run, "e array<double>").toArrow().column("e").combine_chunks()
    rows = found.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(GIVEN) + 1)
    return fit(rows[:, :-1], rows[:, -1]) if len(rows) else GIVEN


def extracted(pages: DataFrame, *, weights: np.ndarray | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html)."""
    weights = learn(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 500):
                batch = whole.slice(lo, 500)
                texts = [main_text(p, weights) if p else "" for p in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
