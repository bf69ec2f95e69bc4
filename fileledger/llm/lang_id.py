"""Language of each text, by a linear-chain conditional random field over its words.

A word's label is scored by its prefixes, suffixes, letter bigrams and trigrams and its shares in a lexicon, hashed into
one table of weights; learned transitions tie neighbours, so that a word that several languages share follows its
neighbours, and a text may switch. Forward-backward gives each word's probabilities, and the text has the language with
the largest mean. The field is trained on sequences whose pieces switch between languages, in several tasks whose
weights are averaged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, strings
from .quality import held_out

WORD = re.compile(r"[^\W\d_]+")
#: Slots of hashed features.
SLOTS = 1 << 15
#: Words of a training sequence, and of the blocks that long texts are cut into.
TRAIN_LENGTH, BLOCK = 32, 64
#: A task forgets the words it has scored once it holds so many, and scores texts together up to so many words.
HELD, TOGETHER = 200_000, 100_000
#: Characters of a text that are cut into words at a time.
PIECE = 1 << 20


def words_of(text: str) -> Iterator[list[str]]:
    """The words of a text in lower case, in order, in pieces that cut no word."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end].isalpha():
            end += 1
        yield WORD.findall(text[at:end].lower())
        at = end


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _slot(kind: int, *codes: np.ndarray) -> np.ndarray:
    """The slots of features of one kind, from their code points."""
    h = np.full(codes[0].shape if codes else (), kind * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
    for c in codes:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return (h % np.uint64(SLOTS)).astype(np.int64)


def features(words: list[str], lexicon: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of words' features: of each letter's place (bigram, trigram) with each word's first place, and of each word (affixes, length, lexicon).

    ``SLOTS`` stands where there is no feature; its weight is 0.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    left = np.repeat(starts + sizes + 1, sizes + 2) - np.arange(len(codes))  # places after this one in its word
    next1, next2 = (np.concatenate((codes[i:], np.zeros(i, np.uint32))) for i in (1, 2))
    places = np.stack((np.where(left >= 1, _slot(2, codes, next1), SLOTS), np.where(left >= 2, _slot(3, codes, next1, next2), SLOTS)), axis=1)
    width = 10 + max(map(len, lexicon.values()), default=0)
    own = np.full((len(words), width), SLOTS, np.int64)
    own[:, 0], own[:, 1] = _slot(1, np.zeros(1)), _slot(1, np.minimum(sizes, 12) + 1)
    for n in (1, 2, 3, 4):
        long = sizes >= n
        at, end = starts[long] + 1, (starts + sizes)[long]
        own[long, 1 + n] = _slot(10 + n, *(codes[at + i] for i in range(n)))
        own[long, 5 + n] = _slot(20 + n, *(codes[end - i] for i in range(n)))
    known = [(i, q) for i, w in enumerate(words) if (q := lexicon.get(w))]
    if known:
        quarters = np.array([q for _, q in known])
        own[[i for i, _ in known], 10:] = _slot(30, np.broadcast_to(np.arange(quarters.shape[1]), quarters.shape), quarters)
    return places, starts, own


def word_scores(weights: np.ndarray, places: np.ndarray, starts: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Sums of the weights (slots and one more x labels) of each word's features."""
    return np.add.reduceat(weights[places[:, 0]] + weights[places[:, 1]], starts, axis=0) + weights[own].sum(axis=1)


@dataclass
class Field:
    """A trained field: its languages, weights by slot and language, transitions (from, to), and lexicon (quarters of a word's use by language)."""

    langs: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: dict[str, list[int]] = field(repr=False)


def forward_backward(scores: np.ndarray, lengths: list[int], moves: np.ndarray) -> np.ndarray:
    """Marginal probabilities (words x labels) of texts whose words stand one after another.

    Texts are cut into blocks. The products of all blocks' matrices are taken side by side, a vector is carried through each
    text's products in both directions, and then all blocks are filled side by side. Nothing is approximated.
    """
    total, k = scores.shape
    counts = np.array(lengths, np.int64)
    blocks = -(-counts // BLOCK)
    first = np.cumsum(blocks) - blocks  # of each text
    place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    row, col = np.repeat(first, counts) + place // BLOCK, place % BLOCK
    # blocks stand by falling size, so that those with more than t words come first
    size = np.bincount(row, minlength=int(blocks.sum()))
    column = np.empty(len(size), np.int64)
    column[np.argsort(-size, kind="stable")] = np.arange(len(size))
    row, n, longest = column[row], len(size), int(size.max())
    wide = [int(c) for c in (size[:, None] > np.arange(longest)).sum(axis=0)]
    e = np.empty((longest, k, n))
    e[col, :, row] = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    step = np.exp(moves - moves.max())
    opens = np.zeros(n, bool)
    opens[column[first]] = True  # no transition leads to a text's first word

    product = np.broadcast_to(np.eye(k)[:, :, None], (k, k, n)).copy()  # (into, from, block)
    for t, m in enumerate(wide):
        x = (step.T @ product[:, :, :m].reshape(k, -1)).reshape(k, k, m)
        if t == 0:
            x[:, :, opens] = np.eye(k)[:, :, None]
        x *= e[t, :, None, :m]
        product[:, :, :m] = x / x.sum(axis=(0, 1)) if t % 4 == 3 else x
    product /= product.sum(axis=(0, 1))
    # into each block from the left, and into its end from the right
    left, right = np.empty((k, n)), np.empty((k, n))
    a, b = np.ones((k, len(counts))), np.ones((k, len(counts)))
    order = np.argsort(-blocks, kind="stable")
    for i in range(int(blocks.max())):
        on = order[: np.searchsorted(-blocks[order], -i)]  # texts with more than i blocks
        at, back = column[first[on] + i], column[first[on] + blocks[on] - 1 - i]
        left[:, at], right[:, back] = a[:, on], b[:, on]
        a[:, on] = x = np.einsum("jkn,kn->jn", product[:, :, at], a[:, on])
        a[:, on] /= x.sum(axis=0)
        b[:, on] = x = np.einsum("jkn,jn->kn", product[:, :, back], b[:, on])
        b[:, on] /= x.sum(axis=0)
    alpha = np.empty_like(e)
    for t, m in enumerate(wide):
        x = step.T @ left[:, :m]
        if t == 0:
            x[:, opens] = 1
        x *= e[t, :, :m]
        left[:, :m] = alpha[t, :, :m] = x / x.sum(axis=0)
    for t in reversed(range(longest)):
        m = wide[t]
        alpha[t, :, :m] *= right[:, :m]
        x = step @ (right[:, :m] * e[t, :, :m])
        right[:, :m] = x / x.sum(axis=0)
    out = alpha[col, :, row]
    return out / out.sum(axis=1, keepdims=True)


class Scorer(dict):
    """Words to numbers of rows of label scores; words met for the first time are scored together before they are needed."""

    def __init__(self, model: Field):
        self.model = model
        self.weights = np.concatenate((model.weights, np.zeros((1, len(model.langs)))))
        self.fresh: list[str] = []
        self.rows = np.empty((0, len(model.langs)))

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n

    def forget(self) -> None:
        self.clear()
        self.rows = self.rows[:0]

    def label(self, texts: list[np.ndarray]) -> list[tuple[str, float]]:
        """Language and mean probability of each text, given as its words' numbers."""
        if not texts:
            return []
        fresh = [word_scores(self.weights, *features(self.fresh[i : i + 20_000], self.model.lexicon)) for i in range(0, len(self.fresh), 20_000)]
        self.rows = np.concatenate((self.rows, *fresh))
        self.fresh.clear()
        ids, lengths = np.concatenate(texts), [len(t) for t in texts]
        marginals = forward_backward(self.rows[ids], lengths, self.model.moves)
        means = np.add.reduceat(marginals, np.concatenate(([0], np.cumsum(lengths)[:-1])), axis=0) / np.array(lengths)[:, None]
        best = means.argmax(axis=1)
        return [(self.model.langs[b], float(min(1.0, m[b]))) for b, m in zip(best.tolist(), means, strict=True)]


def labelled(texts: Iterator[str | None], model: Field) -> Iterator[tuple[str, float]]:
    """Language and score of each text, in order; texts are scored together up to a number of words."""
    scorer = Scorer(model)
    waiting: list[np.ndarray | None] = []
    held = 0

    def give() -> Iterator[tuple[str, float]]:
        found = iter(scorer.label([t for t in waiting if t is not None]))
        for t in waiting:
            yield ("und", 0.0) if t is None else next(found)
        waiting.clear()
        if len(scorer) > HELD:
            scorer.forget()

    for text in texts:
        if model.langs and has_letter(text):
            waiting.append(np.concatenate([np.fromiter(map(scorer.__getitem__, words), np.int32, len(words)) for words in words_of(text)]))
            held += len(waiting[-1])
        else:
            waiting.append(None)
        if held > TOGETHER or len(waiting) >= 4096:
            yield from give()
            held = 0
    yield from give()


def sequences(streams: list[np.ndarray], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and labels (sequences x ``TRAIN_LENGTH``): pieces of the languages' word streams in turn, as long in all as the longest stream for each language."""
    rng = np.random.default_rng(seed)
    filled = [i for i, s in enumerate(streams) if len(s)]
    want = max(TRAIN_LENGTH, max(len(streams[i]) for i in filled)) * len(filled) // TRAIN_LENGTH * TRAIN_LENGTH
    at = dict.fromkeys(filled, 0)
    words, labels, lang, n = [], [], filled[0], 0
    while n < want:
        others = [i for i in filled if i != lang] or filled
        lang = others[int(rng.integers(len(others)))]
        # many short pieces, some longer than a sequence: texts of one language and texts that switch
        size = int(min(want - n, rng.geometric(1 / 8) if rng.random() < 0.5 else 2 * TRAIN_LENGTH))
        stream = streams[lang]
        words.append(stream[(at[lang] + np.arange(size)) % len(stream)])
        labels.append(np.full(size, lang))
        at[lang] += size
        n += size
    return np.concatenate(words).reshape(-1, TRAIN_LENGTH), np.concatenate(labels).reshape(-1, TRAIN_LENGTH)


def train(streams: list[list[str]], lexicon: dict[str, list[int]], seed: int, steps: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions that maximise the penalised likelihood of switching sequences, by Adam over all of them."""
    known: dict[str, int] = {}
    numbered = [np.array([known.setdefault(w, len(known)) for w in s], np.int64) for s in streams]
    places, starts, own = features(list(known), lexicon)
    sizes = np.diff(np.append(starts, len(places)))
    words, gold = sequences(numbered, seed)
    rows, k, n = len(words), len(streams), words.size
    weights, moves = np.zeros((SLOTS + 1, k)), np.zeros((k, k))
    target = np.zeros((len(known), k))
    np.add.at(target, (words.ravel(), gold.ravel()), 1)
    turns = np.zeros((k, k))
    np.add.at(turns, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, moves)]
    for i in range(1, steps + 1):
        scores = word_scores(weights, places, starts, own)[words]
        e = np.exp(scores - scores.max(axis=2, keepdims=True))
        step = np.exp(moves - moves.max())
        alpha, beta = np.empty_like(e), np.empty_like(e)
        alpha[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, TRAIN_LENGTH):
            a = (alpha[:, t - 1] @ step) * e[:, t]
            alpha[:, t] = a / a.sum(axis=1, keepdims=True)
        beta[:, -1] = 1
        pairs = np.zeros((k, k))
        for t in reversed(range(TRAIN_LENGTH - 1)):
            onward = e[:, t + 1] * beta[:, t + 1]
            b = onward @ step.T
            norm = (alpha[:, t] * b).sum(axis=1)
            pairs += (alpha[:, t] / norm[:, None]).T @ onward * step
            beta[:, t] = b / b.sum(axis=1, keepdims=True)
        marginal = alpha * beta
        marginal /= marginal.sum(axis=2, keepdims=True)
        by_word = np.stack([np.bincount(words.ravel(), marginal[:, :, j].ravel(), len(known)) for j in range(k)], axis=1) - target
        spread = np.repeat(by_word, sizes, axis=0)
        slope = np.zeros_like(weights)
        for j in range(k):
            for slots, by in ((places[:, 0], spread[:, j]), (places[:, 1], spread[:, j]), *((c, by_word[:, j]) for c in own.T)):
                slope[:, j] += np.bincount(slots, by, SLOTS + 1)
        slope[SLOTS] = 0
        for p, g, (m, v) in zip((weights, moves), (slope / n + penalty * weights, (pairs - turns) / n + penalty * moves), state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return weights[:SLOTS], moves


def learn(docs: DataFrame, per_lang: int = 400, span: int = 200, lexicon: int = 5000, parts: int = 4, steps: int = 60, penalty: float = 1e-6) -> Field:
    """A field from the rows of ``docs (doc_id, text, lang)`` that aren't held out and have a language and a letter.

    The sample is bounded: of each language at most ``per_lang`` distinct texts with the smallest hashes, of each at most ``span``
    words in a row, from a place that the hash tells. Half of a language's texts give the lexicon (its ``lexicon`` most
    frequent words), the other half the sequences, dealt to ``parts`` tasks; languages of few texts go to each task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "language")
    rows = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").count().withColumn("share", F.least(F.lit(1.0), F.lit(4.0 * per_lang) / F.col("count"))).select("lang", "share")
    # a share of each language is looked at, four times what is needed
    hashed = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    near = hashed.join(F.broadcast(counts), "lang").where(F.shiftrightunsigned("h", 11) / float(1 << 53) < F.col("share"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text, h in zip(batch.column(0).to_pylist(), strings(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                if has_letter(text):
                    words = [w for piece in words_of(text) for w in piece]
                    at = (h & 0xFFFFFFFF) % max(1, len(words) - span + 1)
                    out.append((lang, h, words[at : at + span]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.list_(pa.string())))], names=["lang", "h", "words"])

    texts = near.select("lang", "text", "h").mapInArrow(cut, "lang string, h long, words array<string>").groupBy("lang", "h").agg(F.min("words").alias("words"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.expr("h >>> 11"), "h"))
    sample = scratch.save(texts.withColumn("place", place).where(F.col("place") <= per_lang), "sample")

    sizes = {r.lang: r.n for r in sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Field([], np.zeros((SLOTS, 0)), np.zeros((0, 0)), {})
    used = sample.where(F.col("place") % 2 == 0).select("lang", F.explode("words").alias("word")).groupBy("word", "lang").count()
    used = used.groupBy("word").agg(F.sum("count").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "count"))).alias("by_lang"))
    half = {lang: max(1, n // 2) for lang, n in sizes.items()}
    shares: dict[str, list[int]] = {}
    for r in used.orderBy(F.desc("n"), "word").limit(lexicon).collect():
        per_text = [r.by_lang.get(lang, 0) / half[lang] for lang in langs]
        shares[r.word] = [int(4 * p / sum(per_text) + 0.5) for p in per_text]

    few = F.lit(False)
    for lang, n in sizes.items():
        if n < 100 * parts:
            few = few | (F.col("lang") == lang)
    own = F.floor(F.col("place") / 2) % parts
    dealt = sample.where(F.col("place") % 2 == 1).withColumn("part", F.explode(F.when(few, F.array(*(F.lit(i) for i in range(parts)))).otherwise(F.array(own.cast("int")))))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["lang", "place"])
        streams = [[w for words in group.loc[group.lang == lang, "words"] for w in words] for lang in langs]
        weights, moves = train(streams, shares, int(group.part.iloc[0]), steps, penalty)
        return pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "moves": [moves.astype(np.float64).tobytes()]})

    fitted = dealt.repartition(4 * parts, "part").groupBy("part").applyInPandas(fit, "weights binary, moves binary").collect()  # one row for each part
    k = len(langs)
    weights = np.mean([np.frombuffer(r.weights, np.float32).reshape(SLOTS, k) for r in fitted], axis=0)
    moves = np.mean([np.frombuffer(r.moves, np.float64).reshape(k, k) for r in fitted], axis=0)
    return Field(langs, weights, moves, shares)


def predict_languages(docs: DataFrame, **options) -> DataFrame:
    """``docs (doc_id, text, lang, ...)`` to ``doc_id, held_out, lang_pred, score``, one row per row, repeated ones too.

    ``score`` is the mean probability of the predicted language over all words of the whole text. Null texts and texts without a
    letter are ``und`` with score 0; so is every text where there is nothing to learn from. A null doc_id is held out.
    Rows with a null lang are predicted but not learned from. Other columns are ignored; an empty table gives an empty result.
    """
    model = learn(docs, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(labelled(strings(batch.column(1)), model))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
