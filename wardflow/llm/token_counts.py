"""Token counts, with huge documents cut into overlapping chunks and spliced again.

Texts of up to ``chunk`` characters are counted whole, by the tiktoken library loaded with the very
vocabulary of the tokenizers file: it gives the same tokens several times as fast. A text that
holds a special string goes to the tokenizers library whole. A longer text is encoded by that
library in chunks that overlap; the token offsets of two neighbours in their overlap are compared,
and the text is spliced at a boundary that is a token boundary in both and provably stable: the
character before it is a letter or number and the one after it is a space or a line end. The split
rule of the encoder never joins the two sides of such a place, whatever surrounds them, so the
tokens left of it depend on the left chunk alone and those right of it on the right chunk alone.
Overlaps without such a place are doubled until there is one or the text ends. Special strings
hold no white space, so no stable boundary lies inside one.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from wardflow.llm.bpe_codec import PIECE_RULE, codec_for
from wardflow.llm.common import only, ship_code

#: White space that ends a piece after a letter or number, whatever follows.
STABLE_SPACE = " \n"


@dataclass(frozen=True)
class TokenCountParams:
    vocabulary: str
    limit: int = 1024
    chunk: int = 32_768
    overlap: int = 512


_TOKENIZERS: OrderedDict[str, Tokenizer] = OrderedDict()


def tokenizer_for(file_text: str) -> Tokenizer:
    """The library's tokenizer for a vocabulary file, kept by the worker across tasks."""
    key = hashlib.sha256(file_text.encode()).hexdigest()
    if key not in _TOKENIZERS:
        while len(_TOKENIZERS) >= 2:
            _TOKENIZERS.popitem(last=False)
        made = Tokenizer.from_str(file_text)
        made.no_truncation()
        made.no_padding()
        _TOKENIZERS[key] = made
    return _TOKENIZERS[key]


class Counter:
    """Token counts of short texts, exactly those of a tokenizer with its vocabulary file."""

    def __init__(self, file_text: str):
        self.tokenizer = tokenizer_for(file_text)
        codec = codec_for(file_text)  # refuses files that are not plain byte-level vocabularies
        self.special = list(codec.special)
        self.engine = tiktoken.Encoding("vocabulary", pat_str=PIECE_RULE,
                                        mergeable_ranks=codec.by_bytes, special_tokens={})

    def count(self, text: str) -> int:
        if any(s in text for s in self.special):
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        return len(self.engine.encode_ordinary(text))


_COUNTERS: OrderedDict[str, Counter] = OrderedDict()


def counter_for(file_text: str) -> Counter:
    key = hashlib.sha256(file_text.encode()).hexdigest()
    if key not in _COUNTERS:
        while len(_COUNTERS) >= 2:
            _COUNTERS.popitem(last=False)
        _COUNTERS[key] = Counter(file_text)
    return _COUNTERS[key]


def stable(text: str, at: int) -> bool:
    """Whether a token boundary at ``at`` holds in every context: a word ends and space begins."""
    return 0 < at < len(text) and text[at] in STABLE_SPACE and text[at - 1].isalnum()


def boundaries(tokenizer: Tokenizer, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Begin offsets of all tokens in order, and how many tokens there are before each."""
    offsets = tokenizer.encode(text, add_special_tokens=False).offsets
    begin = np.fromiter((a for a, _ in offsets), np.int64, len(offsets))
    return begin, np.arange(len(offsets))


def count_long(tokenizer: Tokenizer, text: str, chunk: int, overlap: int) -> int:
    """Tokens of ``text`` from overlapping chunks, spliced at stable common boundaries."""
    total, at, n = 0, 0, len(text)
    left, left_from = None, 0
    end = min(n, chunk)
    left, _ = boundaries(tokenizer, text[:end])
    while end < n:
        width = overlap
        while True:
            start = max(at, end - width)
            stop = min(n, start + max(chunk, 2 * width))
            right, _ = boundaries(tokenizer, text[start:stop])
            splice = _splice(text, left + left_from, right + start, max(start, at), end)
            if splice is not None or start == at:
                break
            width *= 2
        if splice is None:
            # No stable place from the last splice to here: take the chunks as one.
            end = min(n, max(end + chunk, at + 2 * (end - at)))
            left, left_from = boundaries(tokenizer, text[at:end])[0], at
            continue
        total += int(np.searchsorted(left + left_from, splice))
        left, left_from = right[np.searchsorted(right + start, splice):], start
        at, end = splice, stop
    return total + len(left)


def _splice(text: str, left: np.ndarray, right: np.ndarray, lo: int, hi: int) -> int | None:
    """The last stable boundary of both encodings inside the overlap, away from its ends."""
    common = np.intersect1d(left[(left > lo) & (left < hi)], right)
    for place in common[::-1]:
        if stable(text, int(place)):
            return int(place)
    return None


ROWS = 128


def _count_batches(vocabulary, params: TokenCountParams):
    def run(batches):
        counter = counter_for(vocabulary.value)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                n_tokens = np.array([
                    counter.count(t) if len(t) <= params.chunk else
                    count_long(counter.tokenizer, t, params.chunk, params.overlap)
                    for t in texts], np.int64)
                n_bytes = [len(t.encode("utf-8")) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens),
                     pa.array(n_tokens > params.limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def count_tokens(docs: DataFrame, params: TokenCountParams) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs(doc_id, text)``.

    Counts are those of the library for the vocabulary file, without added special tokens,
    truncation or padding; special strings inside texts are handled as the library does.

    Null or empty text: 0 bytes, 0 tokens. Null doc_id: returned as such. Repeated rows are
    returned each; an empty table gives an empty result; extra columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    with open(params.vocabulary, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    return only(docs, doc_id="long", text="string").mapInArrow(
        _count_batches(vocabulary, params),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
