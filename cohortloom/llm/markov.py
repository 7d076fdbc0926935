"""Hidden Markov language model.

Frequent words, and a handful of classes for all others, are the symbols that hidden
states emit. Baum-Welch training sums expected counts over partitions; a text's likelihood
comes from the scaled forward recursion over all its symbols, times the chance of each
rarer word within its class by its count.

Counts come from all training documents. Words above a share of the tokens are so few that
every task can hold them; the rest, a list that grows with the corpus, are joined.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .base import id_remainder

#: Latent states, rounds of training, and tokens per training sequence: longer documents
#: are trained in pieces, but scored whole.
STATES, ROUNDS, PIECE = 6, 4, 1024
#: A word with this share of the training tokens is a symbol, so there are 1 / SYMBOL_SHARE at most.
SYMBOL_SHARE = 1e-4
#: A word with this share of all tokens is known to every task: 1 / KNOWN_SHARE at most.
KNOWN_SHARE = 5e-6
SMOOTHING = 1e-2
#: Distinct words and padded tokens that a task holds at a time.
HELD_WORDS, HELD_CELLS = 200_000, 400_000

END = b""  # no word is empty
CLASSES = 12
DIGIT = re.compile(rb"[0-9]")


def tokens(text: str) -> list[bytes]:
    """Words between [\\x20\\x09-\\x0D], A-Z in lower case, in UTF-8."""
    return text.encode().lower().split()


def class_of(word: bytes) -> int:
    """By the look of a word: length, digits, letters beyond ASCII."""
    length = 0 if len(word) <= 5 else 1 if len(word) <= 9 else 2
    return length + 3 * (DIGIT.search(word) is not None) + 6 * (not word.isascii())


def class_column(word: Column) -> Column:
    """The same for a column."""
    size, text = F.octet_length(word), word.cast("string")
    length = F.when(size <= 5, 0).when(size <= 9, 1).otherwise(2)
    return length + 3 * text.rlike("[0-9]").cast("int") + 6 * text.rlike(r"[^\x00-\x7F]").cast("int")


def _halves(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(
        doc_id.alias("doc_id"), (id_remainder(doc_id, 7) == 2).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))


def count_words(halves: DataFrame) -> DataFrame:
    """(word, c, total): occurrences in training documents and in all."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("total", pa.int64())])

    def rows(words: Counter, seen: bool) -> pa.RecordBatch:
        n = pa.array(list(words.values()), pa.int64())
        c = n if seen else pa.array(np.zeros(len(words), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), c, n], schema=schema)

    def count(batches):
        train, held = Counter(), Counter()
        for batch in batches:
            for out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = held if out else train
                own.update(tokens(text))
                own[END] += 1
                if len(own) > HELD_WORDS:
                    yield rows(own, not out)
                    own.clear()
        yield rows(train, True)
        yield rows(held, False)

    return halves.select("held_out", "text").mapInArrow(count, "word binary, c bigint, total bigint").groupBy("word").agg(
        F.sum("c").alias("c"), F.sum("total").alias("total"))


class Vocabulary(NamedTuple):
    """What every task knows of the words: by place, the symbol and three figures."""
    places: dict[bytes, int]
    symbol: np.ndarray  # 0: the end; 1 to CLASSES: a class; then frequent words
    base: np.ndarray  # log10 of the smoothed share
    inner: np.ndarray  # log10 of the share within the class; 0 for a symbol of its own
    seen: np.ndarray  # whether in training documents
    n_symbols: int


class Totals(NamedTuple):
    tokens: int
    distinct: int
    class_tokens: list[int]
    class_distinct: list[int]


def learn_vocabulary(counts: DataFrame) -> tuple[Vocabulary, Totals]:
    counts = counts.withColumn("class", class_column(F.col("word")))
    whole = counts.agg(
        F.sum("c").alias("n"), F.sum("total").alias("all"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n, every, v = whole.n or 0, whole["all"] or 0, whole.v
    is_symbol = (F.col("c") >= max(1, n * SYMBOL_SHARE)) & (F.col("word") != F.lit(END))
    # Bounded by the shares above.
    known = counts.where((F.col("total") >= every * KNOWN_SHARE) | (F.col("word") == F.lit(END))).select(
        "word", "class", "c", is_symbol.alias("own")).toArrow().to_pylist()
    known.sort(key=lambda r: (-r["c"], r["word"]))
    of_class = {r["class"]: r for r in counts.where(~is_symbol & (F.col("word") != F.lit(END))).groupBy("class").agg(
        F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).collect()}
    totals = Totals(
        n, v, [of_class[k]["n"] if k in of_class else 0 for k in range(CLASSES)],
        [of_class[k]["v"] if k in of_class else 0 for k in range(CLASSES)])
    symbols, inner, following = [], [], CLASSES + 1
    for r in known:
        if r["word"] == END:
            symbols.append(0)
        elif r["own"]:
            symbols.append(following)
            following += 1
        else:
            symbols.append(1 + r["class"])
        k = r["class"]
        inner.append(0.0 if symbols[-1] == 0 or r["own"] else np.log10(
            (r["c"] + 1) / (totals.class_tokens[k] + totals.class_distinct[k] + 1)))
    c = np.array([r["c"] for r in known], np.int64)
    return Vocabulary(
        {r["word"]: i for i, r in enumerate(known)}, np.array(symbols, np.int32), np.log10((c + 1) / (n + v + 1)),
        np.array(inner, float), c > 0, following), totals


def encode(halves: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per document: symbols (little-endian unsigned 16-bit), sums over the words
    that every task knows, and the others with their class and number."""
    shared = halves.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        get, end = known.places.get, known.places.get(END)
        for batch in batches:
            rows: list[tuple] = []
            rare_words: list[bytes] = []
            rare_classes: list[int] = []
            rare_numbers: list[int] = []
            ends = [0]
            for text in batch.column(2).to_pylist():
                words = tokens(text)
                places = np.append(np.fromiter(map(get, words, repeat(-1)), np.int64, len(words)), end)
                found = places >= 0
                symbols = known.symbol[places]
                lost = np.flatnonzero(~found).tolist()
                if lost:
                    unknown = Counter([words[i] for i in lost])
                    classes = {w: class_of(w) for w in unknown}
                    symbols[lost] = [1 + classes[words[i]] for i in lost]
                    rare_words += classes
                    rare_classes += classes.values()
                    rare_numbers += unknown.values()
                ends.append(len(rare_words))
                inside = places[found]
                rows.append((
                    len(words) + 1, int(known.seen[inside].sum()), float(known.base[inside].sum()),
                    float(known.inner[inside].sum()), symbols.astype("<u2").tobytes()))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
            others = pa.StructArray.from_arrays(
                [pa.array(rare_words, pa.binary()), pa.array(rare_classes, pa.int32()), pa.array(rare_numbers, pa.int64())],
                ["word", "class", "n"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), others)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "inner", "symbols", "rare"])

    return halves.mapInArrow(
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, inner double, "
             "symbols binary, rare array<struct<word:binary,class:int,n:bigint>>")


class Model(NamedTuple):
    start: np.ndarray
    moves: np.ndarray  # from state, to state
    emits: np.ndarray  # symbol, state


def first_model(n_symbols: int, states: int = STATES) -> Model:
    """Seeded and uneven, so that the states can part."""
    rng = np.random.Generator(np.random.PCG64(7))
    emits = rng.gamma(1.0, 1.0, (n_symbols, states)) + 0.1
    moves = rng.gamma(1.0, 1.0, (states, states)) + 0.5
    return Model(np.full(states, 1 / states), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def _groups(sequences: list[np.ndarray], cells: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """(symbols by step and sequence, lengths, which) with sequences from long to short
    and a bounded number of cells; a longer sequence is a group by itself."""
    order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: -len(sequences[i]))
    at = 0
    while at < len(order):
        longest = len(sequences[order[at]])
        which = order[at:at + max(1, cells // longest)]
        at += len(which)
        table = np.zeros((longest, len(which)), np.int32)
        for k, i in enumerate(which):
            table[:len(sequences[i]), k] = sequences[i]
        yield table, np.array([len(sequences[i]) for i in which]), which


def _active(lengths: np.ndarray, longest: int) -> np.ndarray:
    """How many sequences have a symbol at each step."""
    return np.searchsorted(-lengths, -np.arange(longest), "left")


def likelihoods(sequences: list[np.ndarray], model: Model) -> list[float]:
    """log10 of each sequence's probability by the scaled forward recursion."""
    out = [0.0] * len(sequences)
    for table, lengths, which in _groups(sequences, 4 * HELD_CELLS):
        active = _active(lengths, len(table)).tolist()
        logs = np.zeros(len(which))
        alpha = model.start * model.emits[table[0]]
        for t, n in enumerate(active):
            if t:
                alpha = alpha[:n] @ model.moves
                alpha *= model.emits[table[t, :n]]
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            logs[:n] += np.log10(scale)
        for k, i in enumerate(which):
            out[i] = float(logs[k])
    return out


def expected_counts(sequences: list[tuple[np.ndarray, bool]], model: Model) -> Model:
    """Expected starts, moves and emissions of sequences, each with whether it is the
    beginning of a document."""
    n_symbols, states = model.emits.shape
    start, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((n_symbols, states))
    for table, lengths, which in _groups([s for s, _ in sequences], HELD_CELLS):
        longest, active = len(table), _active(lengths, len(table)).tolist()
        chances = model.emits[table]
        alphas, scales = np.zeros((longest, len(which), states)), np.ones((longest, len(which)))
        alpha = model.start * chances[0]
        for t, n in enumerate(active):
            if t:
                alpha = (alpha[:n] @ model.moves) * chances[t, :n]
            scale = alpha.sum(1)
            alpha = alpha / scale[:, None]
            alphas[t, :n], scales[t, :n] = alpha, scale
        beta = np.ones((len(which), states))
        for t in range(longest - 1, 0, -1):
            n = active[t]
            after = chances[t, :n] * beta[:n] / scales[t, :n, None]
            moves += alphas[t - 1, :n].T @ after
            alphas[t, :n] *= beta[:n]
            beta[:n] = after @ model.moves.T
        alphas[0] *= beta
        begins = np.array([sequences[i][1] for i in which])
        start += alphas[0][begins].sum(0)
        inside = np.arange(longest)[:, None] < lengths
        flat = table[inside]
        for k in range(states):
            emits[:, k] += np.bincount(flat, alphas[:, :, k][inside], n_symbols)
    return Model(start, moves * model.moves, emits)


def train(encoded: DataFrame, n_symbols: int, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch: expected counts are summed within a task, then over tasks by symbol;
    a round brings back one row per symbol, state and start."""
    spark, model = encoded.sparkSession, first_model(n_symbols, states)
    names = [f"e{k}" for k in range(states)]
    sequences = encoded.where("not held_out").select("symbols")
    schema = ", ".join(["row int", *(f"{name} double" for name in names)])
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def count(batches, shared=shared):
            total = Model(*(np.zeros_like(x) for x in shared.value))
            for batch in batches:
                pieces = []
                for data in batch.column(0).to_pylist():
                    symbols = np.frombuffer(data, "<u2").astype(np.int32)
                    pieces += [(symbols[i:i + PIECE], i == 0) for i in range(0, len(symbols), PIECE)]
                total = Model(*(a + b for a, b in zip(total, expected_counts(pieces, shared.value))))
            table = np.concatenate([total.emits, total.moves, total.start[None]])
            rows = np.flatnonzero(table.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), *(pa.array(table[rows, k]) for k in range(states))], ["row", *names])

        summed = sequences.mapInArrow(count, schema).groupBy("row").agg(*[F.sum(x).alias(x) for x in names]).toArrow()
        table = np.zeros((n_symbols + states + 1, states))
        table[summed["row"].to_numpy()] = np.stack([summed[x].to_numpy() for x in names], 1)
        shared.unpersist()
        emits = table[:n_symbols] + SMOOTHING
        moves = table[n_symbols:-1] + SMOOTHING
        start = table[-1] + SMOOTHING
        model = Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
    return model


def score_texts(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every
    document; score is the model's log10 probability of the whole text.

    Tokens are the words and one end. Documents whose crc32(doc_id as text) mod 7 is 2
    are not learned from. A null or empty text is the end alone; a null id counts as an
    empty text in the remainder; repeated rows are counted and scored each; without
    training documents all states and words are alike; an empty table gives no rows;
    other columns are not read.
    """
    halves = _halves(docs)
    counts = staged(count_words(halves))
    vocabulary, totals = learn_vocabulary(counts)
    encoded = staged(encode(halves, vocabulary).withColumn("row", F.monotonically_increasing_id()))
    model = train(encoded, vocabulary.n_symbols, states, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            sequences = [np.frombuffer(s, "<u2").astype(np.int32) for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(likelihoods(sequences, shared.value), pa.float64())], ["row", "path"])

    paths = encoded.select("row", "symbols").mapInArrow(score, "row bigint, path double")
    n, v = totals.tokens, totals.distinct
    sizes = F.array(*[F.lit(float(a + b + 1)) for a, b in zip(totals.class_tokens, totals.class_distinct)])
    rare = encoded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.class", "r.n")
    c, times = F.coalesce("c", F.lit(0)), F.col("n")
    looked_up = rare.join(counts.select("word", "c"), "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, times).otherwise(0)).alias("more_known"),
        F.sum(times * F.log10((c + 1) / F.lit(float(n + v + 1)))).alias("more_base"),
        F.sum(times * F.log10((c + 1) / F.element_at(sizes, F.col("class") + 1))).alias("more_inner"))
    parts = encoded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "inner")
    zero = F.lit(0.0)
    return parts.join(paths, "row").join(looked_up, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("path") + F.col("inner") + F.coalesce("more_inner", zero)).alias("score"))
