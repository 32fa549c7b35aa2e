"""Byte-level BPE encoding and decoding by longest matches and backtracking.

Tokens are byte strings; as Latin-1 text they fit an Aho-Corasick automaton, which
lists every token that starts at every place of a piece in one pass. A sequence
of tokens is what the merges would give exactly when each adjacent pair is what
the merges give for the pair's own bytes, so the longest token compatible with
its predecessor is taken and given up again only where nothing can follow. As the
encoding of each prefix is unique, a place given up once stays given up: every
place is visited once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries of each half of a memo of a task. Longer pieces are not kept.
MEMO, MEMO_PIECE = 1 << 17, 64


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to id, from lines of base64 token and rank."""
    ranks = {}
    for line in content.splitlines():
        if line.strip():
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


class Memo(dict):
    """A dict that computes what it lacks and keeps at most twice ``MEMO`` entries: the latest and those before."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, key):
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if isinstance(key, int) or len(key) <= MEMO_PIECE:
            self[key] = value
        return value


class ByteBPE:
    """Encoder and decoder for one vocabulary and one pattern of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.pieces = regex.compile(pattern).findall
        self.compatible = Memo(self._compatible)
        self.encoded = Memo(self._encoded)

    def _merged(self, data: bytes) -> list[bytes]:
        """The merges themselves, lowest rank first; only used on the bytes of two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [self.ranks.get(a + b, len(self.ranks) + (1 << 30)) for a, b in zip(parts, parts[1:])]
            best = min(found)
            if best >= 1 << 30:
                break
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, pair: int) -> bool:
        left, right = self.token[pair >> 32], self.token[pair & 0xFFFFFFFF]
        return self._merged(left + right) == [left, right]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        starts: list[list[int]] = [[] for _ in piece]
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            starts[end - len(self.token[rank]) + 1].append(rank)  # shorter tokens end first
        chosen: list[int] = []
        ends, given_up, place = [], set(), 0
        while place < len(piece):
            options = starts[place]
            while options:
                rank = options.pop()
                after = place + len(self.token[rank])
                if after not in given_up and (not chosen or self.compatible[chosen[-1] << 32 | rank]):
                    chosen.append(rank)
                    ends.append(after)
                    place = after
                    break
            else:
                if not chosen:
                    raise ValueError("the vocabulary lacks a byte of the text")
                given_up.add(place)
                chosen.pop()
                ends.pop()
                place = ends[-1] if ends else 0
        return chosen

    def _encoded(self, piece: str) -> bytes:
        return np.array(self.encode_piece(piece.encode("utf-8", "replace")), "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self.encoded.__getitem__, self.pieces(text)))

    def decode(self, ids: bytes) -> bytes:
        """The bytes of a sequence of ids."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Vocabulary:
    """What a codec is built from. A worker builds it at the first use and drops it together with the broadcast."""

    def __init__(self, content: bytes, pattern: str):
        self.content, self.pattern = content, pattern
        self._codec: ByteBPE | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_codec": None}

    @property
    def codec(self) -> ByteBPE:
        if self._codec is None:
            self._codec = ByteBPE(read_ranks(self.content), self.pattern)
        return self._codec


class Tokenizer:
    """Column-level encoding for a vocabulary file.

    The driver reads the file once (its size does not hang on the data) and
    broadcasts its bytes, so executors need no copy of it. Spark takes the broadcast
    from a worker that goes on with other work, and the codec with its memos goes too.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as file:
            self.shared = spark.sparkContext.broadcast(Vocabulary(file.read(), pattern))

    def encode(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(id, token_ids)`` of every row; ids as little-endian unsigned 32-bit integers.

        A null or empty text has no ids (an empty binary). Null and repeated ids
        are kept row by row; an empty table gives an empty one; further columns
        of whatever name are not read.
        """
        return self._encoded(docs, id_col, text_col, decoded=False)

    def round_trip(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``encode`` with the bytes that the ids stand for as ``decoded``, from one codec per task."""
        return self._encoded(docs, id_col, text_col, decoded=True)

    def _encoded(self, docs: DataFrame, id_col: str, text_col: str, decoded: bool) -> DataFrame:
        shared = self.shared

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            bpe = shared.value.codec
            for batch in batches:
                ids = [bpe.encode(text) for text in batch["text"]]
                out = {"id": batch["id"], "token_ids": pd.Series(ids, dtype=object)}
                if decoded:
                    out["decoded"] = pd.Series([bpe.decode(x) for x in ids], dtype=object)
                yield pd.DataFrame(out)

        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        kind = f"id {dict(docs.dtypes)[id_col]}, token_ids binary" + ", decoded binary" * decoded
        return rows.mapInPandas(run, kind).withColumnRenamed("id", id_col)

    def decode(self, token_ids: Column) -> Column:
        """The bytes that a binary column of ids stands for; null for null."""
        shared = self.shared

        def run(column: pd.Series) -> pd.Series:
            bpe = shared.value.codec
            return pd.Series([None if ids is None else bpe.decode(ids) for ids in column], dtype=object)

        return F.pandas_udf(run, "binary")(token_ids)


def digests(encoded: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id") -> DataFrame:
    """Number of ids, digest of the ids and digest of the decoded bytes (decoded here, if they are not there) per row."""
    decoded = F.col("decoded") if "decoded" in encoded.columns else tokenizer.decode(F.col("token_ids"))
    return encoded.select(
        id_col,
        F.expr("cast(length(token_ids) div 4 as long)").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )
