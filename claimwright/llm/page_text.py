"""The main text of web pages, by a recurrent labeller of their blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm import bilstm
from claimwright.llm.block_labels import Arranger, by_markup
from claimwright.llm.html_blocks import Block, Path, blocks
from claimwright.llm.memo import Memo

# The sample to learn from: pages with elements that name their parts, arrangements of the
# texts of sampled pages, blocks at most of one training sequence, characters of a page.
SAMPLE_PAGES, ARRANGED_PAGES, SAMPLE_BLOCKS, SAMPLE_CHARS = 300, 1500, 60, 100_000
ROUNDS = 6
# An element counts this much less than the one within it; 20 levels make next to nothing.
DECAY, LEVELS = 0.7, 20
THRESHOLD = 0.5
# Blocks whose labels are found together.
BLOCKS_AT_ONCE = 20_000

Model = dict[str, np.ndarray]


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page: the blocks labelled as the article.

    A page that is null, empty or without such blocks has the empty text. Pages may be of
    any length and have any number of blocks; repeated rows give repeated results. Other
    columns are ignored. The labeller is fitted to a bounded sample of the same pages;
    if none of them has text, nothing is fitted and all texts are empty.
    """
    return extracted(pages, fit_labeller(pages))


def fit_labeller(pages: DataFrame) -> Model | None:
    """A labeller fitted to up to SAMPLE_PAGES different pages, in the order of their hash.

    They serve twice. Where a page's own elements name its parts (an article or main
    element is there), those give the labels. And the texts of all sampled pages are laid
    out anew in many arrangements, by which the labels are known.
    """
    known = pages.where((F.length("html") > 0) & (F.length("html") <= SAMPLE_CHARS))
    drawn = F.xxhash64("html")
    draws = [
        row.draw
        for row in known.select(drawn.alias("draw")).distinct().orderBy("draw").limit(SAMPLE_PAGES).collect()
    ]
    if not draws:
        return None
    sample = (
        known.where(drawn.isin(draws))
        .groupBy(drawn.alias("draw"))
        .agg(F.min("html").alias("html"))
        .orderBy("draw")
        .collect()
    )
    return fit_to_pages([row.html for row in sample])


def fit_to_pages(htmls: list[str]) -> Model | None:
    """A labeller fitted to these pages and to arrangements of their texts."""
    read = [list(blocks(html)) for html in htmls]
    proses = [b.text for page in read for b in page if len(b.text.split()) >= 5 and not b.linked]
    proses = proses or [b.text for page in read for b in page]
    if not proses:
        return None
    labelled = [[(b, by_markup(b)) for b in page] for page in read]
    labelled = [page for page in labelled if any(label for _, label in page)]
    arranger = Arranger(proses, seed=3)
    labelled += [arranger.page() for _ in range(ARRANGED_PAGES)]
    windows = [
        page[at : at + SAMPLE_BLOCKS] for page in labelled for at in range(0, min(len(page), 3 * SAMPLE_BLOCKS), SAMPLE_BLOCKS)
    ]
    return bilstm.fitted(
        [described([block for block, _ in window]) for window in windows],
        [np.array([label for _, label in window], np.float32) for window in windows],
        ROUNDS,
    )


_PATH_TOKEN = Memo(lambda token: zlib.crc32(token.encode()) % bilstm.PATH_BUCKETS, 100_000)
_WORD = Memo(lambda word: zlib.crc32(word.encode("utf-8", "replace")) % bilstm.WORD_BUCKETS, 500_000)


def _path_tokens(path: Path | None) -> tuple[list[int], list[float]]:
    """Tokens of a block's elements with their weights, innermost first."""
    ids, weights = [_PATH_TOKEN["any"]], [1.0]
    weight = 1.0
    for level in range(LEVELS):
        if path is None:
            break
        tag, words = path.element
        names = [f"tag {tag}", *(f"name {word}" for word in words)]
        if level == 0:
            names.append(f"own {tag}")
        ids += [_PATH_TOKEN[name] for name in names]
        weights += [weight] * len(names)
        weight *= DECAY
        path = path.parent
    return ids, weights


def described(page: list[Block]) -> bilstm.Sequence:
    """The blocks of a page as the labeller reads them."""
    path_ids, path_weights, path_starts = [], [], []
    word_ids, word_starts, measures = [], [], []
    tokens: dict[int, tuple[list[int], list[float]]] = {}
    for place, block in enumerate(page):
        key = id(block.path)
        if key not in tokens:
            tokens[key] = _path_tokens(block.path)
        path_starts.append(len(path_ids))
        path_ids += tokens[key][0]
        path_weights += tokens[key][1]
        text = block.text
        words = text.lower().split()
        word_starts.append(len(word_ids))
        word_ids += [_WORD[word] for word in words]
        measures.append(
            (
                1.0,
                np.log1p(len(words)) / 5,
                min(1.0, block.linked / len(text)),
                float(text[-1] in ".!?…:\"'”»"),
                min(1.0, 20 * text.count(",") / len(text)),
                float("©" in text or "|" in text),
                place / len(page),
                1 / (1 + place),
            )
        )
    return bilstm.Sequence(
        np.array(path_ids, np.int64),
        np.array(path_weights, np.float32),
        np.array(path_starts, np.int64),
        np.array(word_ids, np.int64),
        np.array(word_starts, np.int64),
        np.array(measures, np.float32).reshape(len(page), bilstm.MEASURES),
    )


def main_texts(pages: list[list[Block]], model: Model) -> list[str]:
    """The article of each page, its blocks parted by an empty line."""
    found = bilstm.probabilities(model, [described(page) for page in pages])
    return [
        "\n\n".join(b.text for b, p in zip(page, likely) if p >= THRESHOLD)
        for page, likely in zip(pages, found)
    ]


def extracted(pages: DataFrame, model: Model | None) -> DataFrame:
    """``page_id, url, text, n_chars`` by a fitted labeller."""
    kept = [pages.schema["page_id"], pages.schema["url"]]
    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    broadcast = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            held: list[list[Block]] = []
            for html in batch.column(2):
                held.append(list(blocks(html.as_py() or "")) if broadcast.value else [])
                if sum(map(len, held)) >= BLOCKS_AT_ONCE:
                    texts += main_texts(held, broadcast.value)
                    held = []
            if broadcast.value:
                texts += main_texts(held, broadcast.value)
            else:
                texts = [""] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, T.StructType([*kept, *fields]))
