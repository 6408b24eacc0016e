"""The main text of web pages by a recurrent block labeller.

A page is parsed into leaf blocks. A bidirectional LSTM reads each block's tag path and hashed words with a few
plain numbers, for all blocks of the page, and labels each as main text or not in the light of all others.

Nobody labelled the pages, so the labeller learns from a bounded sample of them: blocks below elements whose
names tell what they are get labels, and copies of the sampled pages with other element names, further side
blocks and shifted order teach it to judge by more than the names that these pages happen to use.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.batches import Words, field_list, in_chunks, unused
from grainmill.llm.html_blocks import Block, blocks
from grainmill.llm.recurrent import NUMBERS, PATHS, WORDS, Sequence, label, train

# Names of elements, and of their classes, that hold the main text or something else.
MAIN_TAGS = {"article", "main"}
SIDE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset", "label"}
SIDE_NAMES = set(
    ".ad .ads .advert .advertisement .banner .breadcrumb .breadcrumbs .comment .comments .consent .cookie .copyright .disqus .footer "
    ".header .legal .login .menu .modal .nav .navbar .navigation .newsletter .notice .pager .pagination .popup .promo .related .replies "
    ".reply .respond .search .share .sharing .sidebar .signup .social .sponsor .sponsored .subscribe .toolbar .widget .complementary "
    ".contentinfo".split()
)
#: Paths that the copies of a page give to its main text and to side blocks.
MAIN_PATHS = [
    ("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post", ".body"), ("section", ".story"), ("div", ".entry"),
    ("div", ".main", "article"), ("div", ".article", ".text"), ("div", ".page", "div", ".content"), ("div",), ("section",), ("article", "section"),
]
BEFORE_PATHS = [
    ("nav", "ul", "li"), ("header",), ("header", "nav", "ul", "li"), ("div", ".menu", "ul", "li"), ("div", ".cookie", ".notice", "p"), ("div", ".ad"),
    ("form", ".search"), ("div", ".banner"), ("ul", ".breadcrumb", "li"), ("div", ".header"), ("form", "label"), ("div", ".consent", "p"), ("div", ".nav", "a"),
]
WITHIN_PATHS = [
    ("div", ".ad"), ("aside", "p"), ("div", ".related", "ul", "li"), ("div", ".newsletter", "p"), ("form", "button"), ("div", ".share"),
    ("div", ".promo", "p"), ("nav", ".toc", "li"), ("div", ".sponsored", "p"), ("div", ".notice", "p"),
]
AFTER_PATHS = [
    ("footer",), ("footer", "p"), ("div", ".comments", "p"), ("section", ".comments", "div", ".comment", "p"), ("aside", ".sidebar", "p"),
    ("div", ".sidebar", "ul", "li"), ("div", ".footer"), ("form", ".reply"), ("div", ".related", "p"), ("ol", ".comments", "li", "article", "p"),
    ("ul", ".comment", "li"), ("div", ".social"), ("div", ".widget", "p"), ("div", ".cookie", "p"), ("div", ".copyright"),
]
#: Characters of markup that are worked on together.
CHUNK = 2_000_000


class Describer:
    """Blocks as the labeller's input; knows up to `keep` words."""

    def __init__(self, keep: int = 200_000):
        self.keep, self.words, self.hashes, self.paths = keep, Words(), np.zeros(0, np.int64), {}

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        """Hashes of the names in a path, and of its last names together."""
        if path not in self.paths:
            if len(self.paths) > 50_000:
                self.paths = {}
            names = [n for n in path if n not in ("html", "body")]
            self.paths[path] = np.array([crc32(n.encode("utf-8", "surrogatepass")) % PATHS for n in [*names, "/".join(names[-3:])]], np.int64)
        return self.paths[path]

    def sequence(self, page: list[Block]) -> Sequence:
        if len(self.words) > self.keep:
            self.words, self.hashes = Words(), np.zeros(0, np.int64)
        paths = [self._path(b.path) for b in page]
        split = [b.text.lower().split() for b in page]
        sizes = np.array([len(x) for x in split], np.int64)
        codes = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if self.words.fresh:
            new = [crc32(w.encode("utf-8", "surrogatepass")) % WORDS for w in self.words.fresh]
            self.hashes = np.concatenate((self.hashes, np.array(new, np.int64)))
            self.words.fresh = []
        length = np.array([len(b.text) for b in page], float)
        linked = np.array([b.linked for b in page], float)
        marks = np.array([sum(map(b.text.count, ".,;:!?")) for b in page], float)
        place = np.arange(len(page)) / max(1, len(page) - 1)
        numbers = np.stack(
            (np.log1p(length) / 5, linked / np.maximum(length, 1), marks / np.maximum(sizes, 1), place, 1 - place, length < 30, length > 120), axis=1
        )
        flat = np.concatenate(paths) if paths else np.zeros(0, np.int64)
        return Sequence(flat, np.array([len(p) for p in paths], np.int64), self.hashes[codes], sizes, numbers.reshape(-1, NUMBERS).astype(float))


def told_by_names(block: Block) -> bool | None:
    """Whether the names above a block tell that it is main text (True) or something else (False)."""
    inside = False
    for i, name in enumerate(block.path):
        if name in SIDE_TAGS or name in SIDE_NAMES or (name == "header" and not inside):
            return False
        inside |= name in MAIN_TAGS
    return True if inside else None


def lesson(page: list[Block], rng: np.random.Generator, copies: int) -> list[tuple[list[Block], np.ndarray]]:
    """The page with its labels, and altered copies of it; nothing if no names tell of main text."""
    told = [told_by_names(b) for b in page]
    main = [b for b, t in zip(page, told) if t]
    side = [b for b, t in zip(page, told) if t is False]
    if not main:
        return []
    known = [(b, t) for b, t in zip(page, told) if t is not None]
    out = [([b for b, _ in known], np.array([t for _, t in known], float))]

    def strange(paths, most):
        """Runs of side blocks; comments and notices speak like the main text."""
        found = []
        for _ in range(rng.integers(0, most + 1)):
            path = paths[rng.integers(len(paths))]
            for _ in range(rng.integers(1, 6)):
                source = main if not side or rng.random() < 0.4 else side
                words = source[rng.integers(len(source))].text.split()
                start = int(rng.integers(len(words)))
                text = " ".join(words[start : start + int(rng.integers(1, 30))])
                found.append(Block(text, ("html", "body", *path), len(text) if "li" in path and rng.random() < 0.7 else 0))
        return [(b, 0.0) for b in found]

    for _ in range(copies):
        above = MAIN_PATHS[rng.integers(len(MAIN_PATHS))]
        body = []
        for b in main:
            below = b.path[max(i for i, n in enumerate(b.path) if n in MAIN_TAGS) + 1 :]
            body.append((Block(b.text, ("html", "body", *above, *below), b.linked), 1.0))
        extra = [(Block(b.text, ("html", "body", *above, *b.path[2:]), b.linked), y) for b, y in strange(WITHIN_PATHS, 2)]
        at = int(rng.integers(len(body) + 1))
        page = strange(BEFORE_PATHS, 4) + body[:at] + extra + body[at:] + strange(AFTER_PATHS, 4)
        out.append(([b for b, _ in page], np.array([y for _, y in page])))
    return out


def fit_labeller(pages: DataFrame, html_col: str = "html", fit_pages: int = 300, copies: int = 2, most_blocks: int = 200, seed: int = 5) -> dict | None:
    """The labeller's weights, from `fit_pages` pages at most, picked by a hash of their markup.

    A share of all pages is looked at for pages whose names tell of main text; it grows until enough are found or
    all pages were seen, and the least hashes are the same whatever the share. Only pages with up to `most_blocks`
    blocks are learnt from (that bounds the sample; labelling has no such bound). None if no such page's names
    tell of main text; then the names alone decide on every page.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            useful = []
            for text in batch.column("page").to_pylist():
                found = blocks(text)
                useful.append(0 < len(found) <= most_blocks and any(map(told_by_names, found)))
            yield batch.filter(pa.array(useful, pa.bool_()))

    keyed = pages.select(F.crc32(F.col(html_col).cast("binary")).alias("key"), F.col(html_col).alias("page")).where("page <> ''")
    share = min(1.0, 8 * fit_pages / max(1, pages.count()))  # of the pages, so that enough of them are useful
    while True:
        some = keyed.where(F.col("key") < F.lit(int(share * (1 << 32)))).mapInArrow(told, "key long, page string")
        sample = some.groupBy("key").agg(F.min("page").alias("page")).orderBy("key").limit(fit_pages).collect()
        if len(sample) >= fit_pages or share >= 1:
            break
        share = min(1.0, 8 * share)
    rng, reader = np.random.default_rng(seed), Describer()
    lessons = [x for r in sample for x in lesson(blocks(r["page"]), rng, copies)]
    return train([reader.sequence(p) for p, _ in lessons], [y for _, y in lessons]) if lessons else None


def extract_text(pages: DataFrame, weights: dict | None, html_col: str = "html", into: str = "text") -> DataFrame:
    """Every column of `pages` but the markup (and one named like the result) with the main text.

    Blocks labelled as main text are joined in page order by a line break; a null page, or one without such a
    block, has an empty text. Whole pages are read.
    """
    held = pages.sparkSession.sparkContext.broadcast(weights)
    kept = pages.drop(html_col, into).columns
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").alias(unused(pages, "page")))
    schema = f"{field_list(rows.schema.fields[:-1])}, `{into}` string".removeprefix(", ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, weights = Describer(), held.value
        for batch in batches:
            texts = [x or "" for x in batch.column(batch.num_columns - 1).to_pylist()]
            found: list[str] = []
            for part in in_chunks(texts, CHUNK):
                parsed = [blocks(t) for t in texts[part]]
                if weights is None:
                    picked = [[told_by_names(b) for b in page] for page in parsed]
                else:
                    picked = [logits > 0 for logits in label([reader.sequence(p) for p in parsed], weights)]
                found += ["\n".join(b.text for b, yes in zip(page, chosen) if yes) for page, chosen in zip(parsed, picked)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())], names=[*kept, into])

    return rows.mapInArrow(run, schema)
