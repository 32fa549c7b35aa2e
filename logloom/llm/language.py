"""Language identification by cross-parsing with suffix automata.

A suffix automaton of labelled text knows every substring of it. A word is parsed
by longest matches: the fewer phrases it needs, the more alike it is to that text.
Phrases end with the word (a word is parsed with a mark at both ends), so that the
phrases of a text are the sum over its words and repeated words are parsed once.
Phrases are normalised by the bits that a pointer into the labelled text takes;
the language with the fewest bits wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Label of texts without a letter.
UNDETERMINED = "und"
#: Bits of a language's phrase total inside the packed sum of a text.
FIELD = 48
#: Words of each half of the memo, the latest and those before; longer words are not kept.
MEMO, MEMO_WORD = 1 << 16, 64

_letter = regex.compile(r"\p{L}").search
_words = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall


def words(text: str | None) -> list[str]:
    """Runs of letters with their marks, in lower case."""
    return _words(text.lower()) if text else []


def has_letter(text: str | None) -> bool:
    return bool(text) and _letter(text) is not None


class SuffixAutomaton:
    """All substrings of a set of marked words, as one transition table."""

    def __init__(self, texts: list[str]):
        links, lengths, moves = [-1], [0], [{}]
        last = 0
        for text in texts:
            last = 0  # every word starts anew: one automaton for all of them
            for symbol in text:
                known = moves[last].get(symbol)
                if known is not None and lengths[known] == lengths[last] + 1:
                    last = known
                    continue
                state = last
                if known is None:
                    new = len(moves)
                    moves.append({})
                    lengths.append(lengths[last] + 1)
                    links.append(0)
                    while state != -1 and symbol not in moves[state]:
                        moves[state][symbol] = new
                        state = links[state]
                    last = new
                else:
                    new = None
                if state == -1:
                    continue
                target = moves[state][symbol]
                if lengths[target] == lengths[state] + 1:
                    links[last] = target
                    continue
                copy = len(moves)
                moves.append(dict(moves[target]))
                lengths.append(lengths[state] + 1)
                links.append(links[target])
                links[target] = copy
                if new is not None:
                    links[new] = copy
                else:
                    last = copy
                while state != -1 and moves[state].get(symbol) == target:
                    moves[state][symbol] = copy
                    state = links[state]
        self.moves = {(state << 21) | ord(symbol): to for state, row in enumerate(moves) for symbol, to in row.items()}

    def phrases(self, word: str) -> int:
        """Longest matches that cover a word; an unknown symbol is a phrase of its own."""
        move = self.moves.get
        count = state = 0
        open_phrase = False
        for symbol in map(ord, word):
            to = move((state << 21) | symbol) if open_phrase else None
            if to is None:
                count += 1
                to = move(symbol)
                open_phrase = to is not None
            state = to or 0
        return count


def marked(word: str) -> str:
    return f" {word} "


class LanguageModel:
    """One automaton per language, over equal amounts of text."""

    def __init__(self, samples: dict[str, list[str]], budget: int):
        """``samples``: whole texts per language; at most ``budget`` characters of words are used."""
        used: dict[str, list[str]] = {}
        for lang, texts in samples.items():
            left, chosen = budget, []
            for word in (word for text in texts for word in words(text)):
                left -= len(word) + 2
                if left < 0:
                    break
                chosen.append(marked(word))
            if chosen:
                used[lang] = chosen
        self.langs = sorted(used)
        self.automata = [SuffixAutomaton(sorted(set(used[lang]))) for lang in self.langs]
        self.bits = np.array([log2(2 + sum(map(len, used[lang]))) for lang in self.langs])
        self.memo: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _packed(self, word: str) -> int:
        """Phrases of a word in every language, side by side in one integer."""
        text, total = marked(word), 0
        for place, automaton in enumerate(self.automata):
            total |= automaton.phrases(text) << (FIELD * place)
        return total

    def costs(self, text: str | None) -> np.ndarray | None:
        """Bits per language, or None for a text without a letter."""
        found = words(text)
        if not found or not self.langs:
            return None
        memo, total = self.memo, 0
        for word in found:
            packed = memo.get(word)
            if packed is None:
                if len(memo) >= MEMO:
                    self.older, memo = memo, {}
                    self.memo = memo
                packed = self.older.get(word) or self._packed(word)
                if len(word) <= MEMO_WORD:
                    memo[word] = packed
            total += packed
        mask = (1 << FIELD) - 1
        return self.bits * [(total >> (FIELD * place)) & mask for place in range(len(self.langs))]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language of the fewest bits (ties: first by name) and its share of the odds."""
        costs = self.costs(text)
        if costs is None:
            return UNDETERMINED, 0.0
        best = int(np.argmin(costs))
        odds = np.exp2(np.maximum(costs[best] - costs, -1000.0) / 8)
        return self.langs[best], float(1 / odds.sum())


def held_out(id_col: str):
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = 60, budget: int = 60_000) -> LanguageModel:
    """Learn from at most ``rows`` labelled texts and ``budget`` characters per language.

    The sample is the same on every run: the texts of up to 8,000 characters come
    first, then by a hash of the id. It is bounded by languages x rows, whatever
    the size of ``docs``; texts beyond ``budget`` characters are cut for learning only.
    """
    label = F.col(lang_col)
    text = F.substring(text_col, 1, budget)
    known = docs.where(~held_out(id_col) & label.isNotNull() & F.col(text_col).isNotNull())
    order = [F.length(text_col) > 8000, F.xxhash64(F.col(id_col)), F.col(id_col)]
    known = known.select(label.alias("lang"), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("o"), text.alias("text"))
    ranked = known.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("o"))).where(F.col("n") <= rows)
    samples: dict[str, list[str]] = {}
    for row in sorted(ranked.select("lang", "n", "text").collect(), key=lambda r: (r.lang, r.n)):
        samples.setdefault(row.lang, []).append(row.text)
    return LanguageModel(samples, budget)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` of every row, from its whole text alone.

    A null text or one without a letter is ``und`` with score 0, as is every text
    if nothing could be learned. Null ids count as not held out. Repeated rows
    repeat the result; other columns are not read; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shared.value.predict(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "held_out": batch["held_out"],
                    "lang_pred": [lang for lang, _ in found],
                    "score": [score for _, score in found],
                }
            )

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)


def label(docs: DataFrame, model: LanguageModel, sure: float = 0.9, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text has a letter, with the language found in it.

    Every whole text is identified. The answer replaces a null language, and a given
    one if its score is at least ``sure``. Null texts and texts without a letter go.
    Where nothing could be learned, texts with a letter stay as they are. All other
    columns stay, and so do repeated rows and null ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def found(texts: pd.Series, given: pd.Series) -> pd.Series:
        known, out = shared.value, []
        for text, lang in zip(texts, given):
            if not has_letter(text):
                out.append(None)
            elif not known.langs:
                out.append(lang or "")
            else:
                guess, score = known.predict(text)
                out.append(guess if lang is None or score >= sure else lang)
        return pd.Series(out, dtype=object)

    names = docs.columns
    # the optimizer would put the answer into the filter, too, and ask a second worker for it
    told = F.pandas_udf(found, "string").asNondeterministic()(F.col(text_col).cast("string"), F.col(lang_col).cast("string"))
    rows = docs.select(*names, told.alias("_told")).where("_told is not null")
    lang = F.coalesce(F.nullif("_told", F.lit("")).cast(docs.schema[lang_col].dataType), F.col(lang_col)).alias(lang_col)
    return rows.select(*(lang if name == lang_col else F.col(name) for name in names))
