"""Operator 10: token counts by byte-pair merging with a heap and a linked list.

A word's symbols form a doubly linked list; a heap holds its adjacent pairs by
merge rank. The pair of lowest rank is popped again and again and merged. The
count is the number of initial symbols less the merges; no ids are made.

The vocabulary lower-cases and drops white space, so a document's count is the
sum over its words, and each executor merges a word once and remembers its count.
"""

import heapq
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm.common import table

#: Words remembered by one worker; beyond that it starts anew. Longer words are merged each time.
CACHE_WORDS, CACHE_LENGTH = 600_000, 40
#: Words of plain texts, by the split pattern of the vocabulary: contractions, letters, single digits, other signs.
PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Any sign outside these ranges (basic, Latin-1 and extended Latin letters) sends the text through the library's own splitting.
NOT_PLAIN = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ňŊ-ž]")


class Merger:
    """Merge ranks and splitting rules of one vocabulary file."""

    def __init__(self, file: str):
        import public_tokenizers
        from tokenizers import Tokenizer
        path = public_tokenizers.path(file)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.lib = Tokenizer.from_file(path)
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]))
        self.byte = {}                    # the sign that stands for each byte in the vocabulary
        self.cache: dict[str, int] = {}
        for b in range(256):
            printable = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255
            self.byte[b] = chr(b) if printable else chr(256 + sum(
                not (33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255) for x in range(b)))

    def merged(self, signs: str) -> int:
        """Tokens of one word, given as the vocabulary's signs for its bytes."""
        parts = list(signs)
        parts[-1] += self.suffix
        n, rank = len(parts), self.rank
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:      # one of the two has merged since
                continue
            parts[i], parts[j] = left + right, ""
            after[i] = k = after[j]
            count -= 1
            if k < n:
                before[k] = i
                if (r := rank.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (r := rank.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return count

    def word(self, w: str) -> int:
        c = self.cache.get(w)
        if c is None:
            c = self.merged("".join(map(self.byte.__getitem__, w.encode())))
            if len(w) <= CACHE_LENGTH:
                if len(self.cache) >= CACHE_WORDS:
                    self.cache.clear()
                self.cache[w] = c
        return c

    def count(self, text: str) -> int:
        total = 0
        for i, part in enumerate(self.special.split(text) if "<|" in text else [text]):
            total += i > 0                                           # the special token between two parts
            if NOT_PLAIN.search(part):
                part = self.lib.normalizer.normalize_str(part)
                total += sum(map(self.merged, (p for p, _ in self.lib.pre_tokenizer.pre_tokenize_str(part))))
            else:
                total += sum(n * self.word(w) for w, n in Counter(PLAIN_WORDS.findall(part.lower())).items())
        return total


@lru_cache(maxsize=2)
def merger(file: str) -> Merger:
    return Merger(file)


def token_counts(docs: DataFrame, file: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    A null text counts as empty: 0 bytes, 0 tokens. Null ids and repeated rows each give
    their row, other columns are not read, an empty table gives an empty result. Texts of
    any length are counted whole; a word of any length in n log n time.
    """

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = merger(file)
        for texts in batches:
            yield pd.Series([m.count(t) for t in texts], dtype="int64")

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text).alias("n_tokens"))
                .withColumn("over_limit", F.col("n_tokens") > limit))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
