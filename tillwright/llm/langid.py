"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a sample of its labelled text is built. A text is parsed
against it: from each place the longest run that occurs in the sample is taken as one phrase,
and the next phrase begins behind it. The language whose sample needs the fewest phrases, in
proportion to the text's length, wins.

The sample is bounded by documented parameters (documents and characters a language); the texts
to be judged are read whole. Long texts are parsed in stretches of ``stretch`` characters, many
stretches abreast; a stretch's end also ends a phrase.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillwright.llm.textbatch import slices

UNKNOWN = "und"
#: Letters of a language's sample up to which its automaton is a full table; with more, only its transitions are kept.
DENSE = 256
#: The code of a letter that no sample holds, which matches nothing.
UNSEEN = 2
#: The end of a text or stretch, over which nothing is counted.
PAD = 0


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 40
    sample_chars: int = 24_000
    #: A long text gives pieces of at least so many characters, and at most so many pieces.
    piece_chars: int = 300
    pieces: int = 80
    stretch: int = 1024


def normalise(text: str) -> str:
    """Lower case, with each run of anything but letters as one space, none at either end."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


@cache
def _classes() -> np.ndarray:
    """For each code point, the code point of its lower-case letter, or 0."""
    table = np.zeros(sys.maxunicode + 1, np.int64)
    for p in range(len(table)):
        c = chr(p)
        if c.isalpha():
            low = c.lower()
            table[p] = ord(low) if len(low) == 1 else p
    return table


def transitions(codes: list[int]) -> list[dict[int, int]]:
    """Suffix automaton of a sequence of letter codes: for each state, code to state."""
    steps: list[dict[int, int]] = [{}]
    links, lengths = [-1], [0]
    last = 0
    for c in codes:
        new = len(steps)
        steps.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = new
            p = links[p]
        if p >= 0:
            q = steps[p][c]
            if lengths[q] == lengths[p] + 1:
                links[new] = q
            else:
                twin = len(steps)
                steps.append(dict(steps[q]))
                links.append(links[q])
                lengths.append(lengths[p] + 1)
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = twin
                    p = links[p]
                links[q] = links[new] = twin
        last = new
    return steps


def automaton(codes: list[int], width: int) -> np.ndarray:
    """Table of the suffix automaton of a sequence of letter codes: state x code to state, or -1."""
    found = transitions(codes)
    steps = np.full((len(found), width), -1, np.int32)
    for state, row in enumerate(found):
        steps[state, list(row)] = list(row.values())
    return steps


@dataclass
class Parser:
    """Phrases of one language.

    ``own`` gives the language's code of each letter code. With few letters, ``steps`` is a table of
    state x own code, an entry twice the next row, plus 1 if a phrase begins. With many, ``keys``
    are the known (state, own code) in order, ``nexts`` the states they lead to.
    """

    own: np.ndarray
    width: int
    root: np.ndarray  # own code to state, the root for letters that the sample lacks
    steps: np.ndarray | None
    keys: np.ndarray | None
    nexts: np.ndarray | None

    @classmethod
    def of(cls, codes: list[int], size: int, kind: type) -> Parser:
        """From a sample of letter codes below ``size``."""
        letters = sorted({*codes} - {1})
        own = np.full(size, UNSEEN, kind)
        own[[PAD, 1]] = PAD, 1
        own[letters] = np.arange(3, len(letters) + 3)
        width = len(letters) + 3
        plain = own[codes].tolist()
        if len(letters) <= DENSE:
            table = automaton(plain, width)
            # An entry's last bit: the letter opens a phrase, as the match ended before it or it stands at
            # the root. A letter that the sample lacks is a phrase of its own and leads back to the root.
            ended = table < 0
            opened = np.where(table[0] >= 0, table[0], 0)
            steps = 2 * np.where(ended, opened[None, :], table) + ended
            steps[0] = 2 * opened + 1
            steps[:, PAD] = 2 * np.arange(len(table))
            return cls(own, width, opened, steps.astype(np.int32).ravel(), None, None)
        found = transitions(plain)
        known = sorted((state * width + c, to) for state, row in enumerate(found) for c, to in row.items())
        root = np.zeros(width, np.int64)
        root[list(found[0])] = list(found[0].values())
        keys, nexts = np.array(known, np.int64).T
        return cls(own, width, root, None, np.ascontiguousarray(keys), np.ascontiguousarray(nexts))

    def walk(self, grid: np.ndarray, live: list[int]) -> np.ndarray:
        """Phrases of each column of letter codes, of which the first ``live[i]`` reach row i."""
        state = np.zeros(grid.shape[1], np.int64)
        count = np.zeros(grid.shape[1], np.int64)
        for row, n in zip(grid, live):
            at, codes = state[:n], self.own[row[:n]]
            if self.steps is not None:
                np.add(at, codes, out=at)
                entry = self.steps[at]
                count[:n] += entry & 1
                np.multiply(entry >> 1, self.width, out=at)
            else:
                wanted = at * self.width + codes
                place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                known = self.keys[place] == wanted
                count[:n] += ~known | (at == 0)
                at[:] = np.where(known, self.nexts[place], self.root[codes])
        return count


@dataclass
class Model:
    """A parser a language, over common letter codes: 0 pads, 1 is the space, 2 any letter that no sample holds."""

    languages: list[str]
    letters: np.ndarray  # code point to letter code
    parsers: list[Parser]
    stretch: int

    @classmethod
    def train(cls, samples: dict[str, str], settings: Settings) -> Model:
        """From the normalised sample text of each language."""
        alphabet = sorted({c for s in samples.values() for c in s if c != " "})
        code = {c: i + 3 for i, c in enumerate(alphabet)} | {" ": 1}
        size = len(alphabet) + 3
        kind = np.uint16 if size < 1 << 16 else np.uint32
        base = _classes()
        of_letter = np.full(len(base), UNSEEN, kind)
        of_letter[[ord(c) for c in alphabet]] = np.arange(3, size)
        letters = np.where(base > 0, of_letter[base], 1).astype(kind)
        parsers = [Parser.of([code[c] for c in samples[language]], size, kind) for language in sorted(samples)]
        return cls(sorted(samples), letters, parsers, settings.stretch)

    def _codes(self, text: str) -> np.ndarray:
        codes = self.letters[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        keep = (codes != 1) | np.concatenate([[False], codes[:-1] != 1])[:len(codes)]
        codes = codes[keep]
        return codes[:-1] if len(codes) and codes[-1] == 1 else codes

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages) phrases of each text, and the texts' lengths after normalising."""
        coded = [self._codes(t) if t else np.zeros(0, np.int64) for t in texts]
        lengths = np.array([len(c) for c in coded], np.int64)
        counts = -(-lengths // self.stretch)
        total = int(counts.sum())
        result = np.zeros((len(texts), len(self.languages)), np.int64)
        if not total:
            return result, lengths
        owner = np.repeat(np.arange(len(texts)), counts)
        firsts = np.cumsum(counts) - counts
        place = np.arange(total) - firsts[owner]
        sizes = np.minimum(lengths[owner] - place * self.stretch, self.stretch)
        # Longest stretches first, so that those still under way stay together at the front.
        order = np.argsort(-sizes, kind="stable")
        grid = np.zeros((total, self.stretch), self.letters.dtype)
        rank = np.empty(total, np.int64)
        rank[order] = np.arange(total)
        row = 0
        for codes in coded:
            for s in range(0, len(codes), self.stretch):
                part = codes[s:s + self.stretch]
                grid[rank[row], :len(part)] = part
                row += 1
        grid = np.ascontiguousarray(grid.T)
        sorted_sizes = sizes[order]
        live = np.searchsorted(-sorted_sizes, -np.arange(self.stretch), "left")
        for k, parser in enumerate(self.parsers):
            opened = parser.walk(grid[:int(sorted_sizes[0])], live.tolist())
            result[:, k] = np.bincount(owner[order], weights=opened, minlength=len(texts)).astype(np.int64)
        return result, lengths

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, float | None]]:
        """Language, score and rate of each text.

        The score is how far the winner's phrase count lies below the next best's, the rate the
        winner's phrases a character.
        """
        phrases, lengths = self.phrases(texts)
        answers = []
        for counts, length in zip(phrases.tolist(), lengths.tolist()):
            if not length or not self.languages:
                answers.append((UNKNOWN, 0.0, None))
                continue
            ranked = sorted((c / length, language) for c, language in zip(counts, self.languages))
            score = 1.0 if len(ranked) == 1 else 1.0 - ranked[0][0] / ranked[1][0]
            answers.append((ranked[0][1], score, ranked[0][0]))
        return answers


def samples(labelled: DataFrame, settings: Settings) -> dict[str, str]:
    """Sample text of each language: at most ``sample_docs`` distinct texts and ``sample_chars`` normalised characters.

    The texts are chosen by a hash of text, so whichever rows come first does not matter, and a text
    counts once however many copies it has. Short ones give all they have, and longer ones share
    what that leaves, in pieces spread over their whole length. Only these bounded samples reach the
    driver; text is not shuffled, only its hashes are. Of a text of more than ``piece_chars`` times
    ``pieces`` letters and spaces, as many pieces in equal distances are sent.
    """
    hashed = labelled.filter("lang is not null and text is not null and length(text) > 0").select(
        "lang", "text", F.xxhash64("text").alias("h"))
    chosen = hashed.select("lang", "h").distinct()
    # The least of parts of a language first, so that one with most of the texts is not one task's.
    for parts in ([F.col("lang"), F.pmod("h", F.lit(16))], [F.col("lang")]):
        rank = F.row_number().over(Window.partitionBy(*parts).orderBy("h"))
        chosen = chosen.withColumn("n", rank).filter(F.col("n") <= settings.sample_docs).select("lang", "h")
    piece, most = settings.piece_chars, settings.pieces
    spread = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.substring(
        F.col("plain"), (F.floor(i * (F.length("plain") - piece) / (most - 1)) + 1).cast("int"), F.lit(piece)))
    sent = F.when(F.length("plain") <= piece * most, F.array("plain")).otherwise(spread)
    picked = (hashed.join(F.broadcast(chosen), ["lang", "h"], "left_semi")
              .select("lang", "h", F.regexp_replace("text", r"\P{L}+", " ").alias("plain"))
              .select("lang", "h", sent.alias("parts")).distinct())
    texts: dict[str, list[tuple[int, list[str]]]] = {}
    for row in picked.collect():
        texts.setdefault(row.lang, []).append((row.h, row.parts))
    joined = {}
    for language, found in texts.items():
        plain = [" ".join(filter(None, (normalise(p) for p in parts))) for _, parts in sorted(found)]
        sample = shared_out([p for p in plain if p], settings)
        if sample:
            joined[language] = sample
    return joined


def shared_out(texts: list[str], settings: Settings) -> str:
    """``sample_chars`` of the texts: all of the short ones, equal shares of the others in pieces over their length."""
    left, shares = settings.sample_chars - max(0, len(texts) - 1), [0] * len(texts)
    for done, i in enumerate(sorted(range(len(texts)), key=lambda i: len(texts[i]))):
        shares[i] = min(len(texts[i]), max(0, left) // (len(texts) - done))
        left -= shares[i]
    parts = []
    for text, share in zip(texts, shares):
        n = max(1, min(settings.pieces, share // settings.piece_chars)) if share < len(text) else 1
        size = (share - (n - 1)) // n
        starts = [i * (len(text) - size) // max(1, n - 1) for i in range(n)]
        parts += [text[at:at + size].strip() for at in starts]
    return " ".join(filter(None, parts))[:settings.sample_chars]


def train(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Model of the languages in column ``lang``; a null label or text teaches nothing."""
    return Model.train(samples(labelled, settings), settings)


def predict(docs: DataFrame, model: Model, language: str = "lang_pred", score: str = "lang_score",
            rate: str = "lang_rate") -> DataFrame:
    """``docs`` with the language of each row's text, ``und`` if it is null or has no letter, and a score.

    The rate, phrases a character, is near 1 for text that is like none of the languages.

    The score lies between 0 (the two best languages need equally many phrases) and 1. Ties go to
    the first language by name. Nothing is shuffled; columns of those names are replaced.
    """
    docs = docs.drop(language, score, rate)
    schema = T.StructType(list(docs.schema)).add(language, "string").add(score, "double").add(rate, "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            answers = shared.value.judge(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([a[0] for a in answers], pa.string()),
                 *[pa.array([a[i] for a in answers], pa.float64()) for i in (1, 2)]],
                [*batch.schema.names, language, score, rate])

    return docs.mapInArrow(run, schema)
