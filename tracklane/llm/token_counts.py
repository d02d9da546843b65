"""Token counts by byte-pair merging without identifiers.

A text's count is the sum over its pre-tokens of (initial symbols - merges). Each pre-token is a doubly linked list of
symbols with a heap of adjacent pairs; the pair of lowest rank (leftmost of equals) is popped and merged until no
adjacent pair has a rank. Counts of distinct pre-tokens and odd words are remembered, up to a bound, in each Python worker.

Null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated rows. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tracklane.llm import common
from tracklane.llm.word_pieces import Pieces

#: Bytes of text in one step of a task.
STEP_BYTES = 12_000_000
#: Byte -> its symbol in byte-level vocabularies: visible Latin-1 characters are their own, the others follow after 255.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
BYTES = [chr(b) if b in _SHOWN else chr(256 + _HIDDEN.index(b)) for b in range(256)]


class MergeCounter:
    """Counts the tokens of a text for a word-level byte-pair vocabulary file with an end-of-word mark.

    The library's own normaliser and splitter make the pre-tokens, so that both agree on every character's class.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.end = spec["model"]["end_of_word_suffix"] or ""
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(spec["model"]["merges"])}
        added = [re.escape(x["content"]) for x in spec["added_tokens"]]
        self.is_added = re.compile("|".join(added)) if added else None

    def merged(self, symbols: list[str]) -> int:
        """Symbols left when no adjacent pair has a rank."""
        n = len(symbols)
        rank = self.rank.get
        heap = [(r, i) for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := rank(pair)) is not None]
        if not heap:
            return n
        heapq.heapify(heap)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        gone = set()
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if i in gone or j < 0 or rank((symbols[i], symbols[j])) != r:
                continue  # an older entry: one of the two has merged since
            symbols[i] = both = symbols[i] + symbols[j]
            gone.add(j)
            n -= 1
            h, k = before[i], after[j]
            after[i] = k
            if k >= 0:
                before[k] = i
                if (r := rank((both, symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if h >= 0 and (r := rank((symbols[h], both))) is not None:
                heapq.heappush(heap, (r, h))
        return n

    def plain(self, text: str) -> int:
        total = 0
        for piece, _ in self.split(self.normal(text)):
            symbols = list(piece)
            symbols[-1] += self.end
            total += self.merged(symbols)
        return total

    def piece(self, text: str) -> int:
        """Tokens of one lower-case piece: its bytes are the first symbols, the last one with the mark of a word's end."""
        symbols = list(text) if text.isascii() else [BYTES[b] for b in text.encode()]
        symbols[-1] += self.end
        return self.merged(symbols)

    def count(self, word: str) -> int:
        """Tokens of a run of text without white space. Added tokens inside it count one each."""
        if self.is_added and self.is_added.search(word):
            parts = self.is_added.split(word)
            return len(parts) - 1 + sum(map(self.plain, parts))
        return self.plain(word)

    def values(self, plain: list[str], whole: list[str]) -> tuple[np.ndarray, np.ndarray]:
        n = [*map(self.piece, plain), *map(self.count, whole)]
        return np.array(n, np.int64), np.ones(len(n), np.int64)


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


@lru_cache(maxsize=2)
def piece_counts(path: str) -> Pieces:
    return Pieces(path, counter(path).values)


def count_tokens(df: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row of `df`; one narrow stage, no shuffle.

    vocabulary: path of the tokenizer's .json file on every executor.
    """
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_counts(vocabulary)
        for batch in batches:
            for part in common.slices(batch, "t", STEP_BYTES):
                words, at = common.split_words(part.column("t"))
                coded = words.dictionary_encode()
                counts, begin, size = own.of(coded.dictionary)
                total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                each = total[begin + size] - total[begin]
                n = common.sums(each[coded.indices.to_numpy(zero_copy_only=False)], at)
                size = pc.cast(pc.fill_null(pc.binary_length(part.column("t")), 0), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("i"), size, pa.array(n, pa.int64()), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return df.select(df[id_col].alias("i"), df[text_col].alias("t")).mapInArrow(run, schema)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(common.table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
