"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are read as windows of UTF-8 bytes that together cover every byte once. Two recurrent
layers run over a window, one from each end; at every byte their states give the chances of
the languages, and a document's chances are the mean over all of its bytes. The network is
trained here, in numpy, by backpropagation through time, on a bounded sample of labelled
windows; it is applied by Spark tasks, some thousand windows at a time.
"""

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from standwise.llm.common import column, per_batch, texts
from standwise.sources.staging import stage

# Bytes in a window, states in each direction, windows worked on together.
WIDTH, STATES, TOGETHER = 64, 10, 2048
# The sample: documents of each language, and windows of each document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 400, 8
EPOCHS, BATCH, RATE, SEED = 8, 128, 0.01, 7
UNKNOWN = "und"
# Languages whose counts may be broadcast.
BROADCAST_LANGUAGES = 100_000
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(body: bytes) -> bool:
    if _ASCII_LETTER.search(body):
        return True
    return any(c.isalpha() for c in body.decode("utf-8", "ignore"))


def windows(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a text, one per row, and how many bytes at the end of each are new.

    The last window reaches back into the one before; a short text is filled up by blanks.
    """
    if len(body) <= WIDTH:
        row = np.frombuffer(body.rjust(WIDTH), np.uint8)
        return row[None, :], np.array([max(1, len(body))])
    data = np.frombuffer(body, np.uint8)
    whole, rest = divmod(len(body), WIDTH)
    rows = data[: whole * WIDTH].reshape(whole, WIDTH)
    new = np.full(whole, WIDTH)
    if rest:
        rows = np.concatenate([rows, data[None, -WIDTH:]])
        new = np.append(new, rest)
    return rows, new


class Network:
    """Weights, and the passes through them. Arrays are (features, windows) at each byte."""

    NAMES = ("in_f", "in_b", "own_f", "own_b", "out", "bias")

    def __init__(self, languages: list[str], states: int = STATES, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.languages, self.states = languages, states
        small = lambda *shape: draw.normal(0, 0.3, shape).astype("f4")
        # Gates: update, reset, candidate. The gates are piecewise linear, 0.5 at rest.
        self.in_f, self.in_b = small(3 * states, 256), small(3 * states, 256)
        for table in (self.in_f, self.in_b):
            table[: 2 * states] += 0.5
        self.own_f, self.own_b = small(3 * states, states), small(3 * states, states)
        self.out = small(len(languages), 2 * states)
        self.bias = np.zeros((len(languages), 1), "f4")

    def weights(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in self.NAMES]

    def run(self, table, own, symbols, keep: bool):
        """States after each byte; symbols is (bytes, windows). With what learning needs."""
        n, h = self.states, np.zeros((self.states, symbols.shape[1]), "f4")
        states = np.empty((len(symbols), n, symbols.shape[1]), "f4")
        kept = []
        for t, row in enumerate(symbols):
            x, g = np.take(table, row, axis=1), own @ h
            gates = x[: 2 * n]
            gates += g[: 2 * n]
            open_ = (gates > 0) & (gates < 1) if keep else None
            np.clip(gates, 0, 1, out=gates)
            update, reset, inner = gates[:n], gates[n:], g[2 * n :]
            candidate = x[2 * n :]
            candidate += reset * inner
            np.tanh(candidate, out=candidate)
            if keep:
                kept.append((h, open_, update, reset, inner, candidate))
            h = h - candidate
            h *= update
            h += candidate
            states[t] = h
        return states, kept

    def back(self, table, own, symbols, kept, d_states):
        """Gradients of the table and of the recurrent weights."""
        n = self.states
        d_table, d_own = np.zeros_like(table), np.zeros_like(own)
        d_h = np.zeros_like(d_states[0])
        flat = np.empty((3 * n, symbols.shape[1]), "f4")
        for t in range(len(symbols) - 1, -1, -1):
            h, open_, update, reset, inner, candidate = kept[t]
            d_h = d_h + d_states[t]
            d_candidate = d_h * (1 - update) * (1 - candidate * candidate)
            flat[:n] = d_h * (h - candidate) * open_[:n]
            flat[n : 2 * n] = d_candidate * inner * open_[n:]
            flat[2 * n :] = d_candidate
            one = np.zeros((symbols.shape[1], 256), "f4")
            one[np.arange(symbols.shape[1]), symbols[t]] = 1
            d_table += flat @ one
            flat[2 * n :] *= reset
            d_own += flat @ h.T
            d_h = d_h * update + own.T @ flat
        return d_table, d_own

    def chances(self, states: np.ndarray) -> np.ndarray:
        """(languages, bytes, windows) from the states of both directions."""
        n_bytes, n, n_windows = states.shape
        scores = np.matmul(self.out, states) + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores.transpose(1, 0, 2)

    def label(self, rows: np.ndarray, keep: bool = False):
        """Chances at every byte of windows (windows, bytes)."""
        symbols = np.ascontiguousarray(rows.T)
        forward, kept_f = self.run(self.in_f, self.own_f, symbols, keep)
        backward, kept_b = self.run(self.in_b, self.own_b, symbols[::-1], keep)
        states = np.concatenate([forward, backward[::-1]], axis=1)
        found = self.chances(states)
        return (found, symbols, states, kept_f, kept_b) if keep else found

    def gradients(self, rows: np.ndarray, language: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all bytes of the windows, and its gradients."""
        found, symbols, states, kept_f, kept_b = self.label(rows, True)
        n_bytes, n_windows, n = symbols.shape[0], len(rows), self.states
        right = found[language, :, np.arange(n_windows)]
        d = found.copy()
        d[language, :, np.arange(n_windows)] -= 1
        d /= n_bytes * n_windows
        d = np.ascontiguousarray(d.transpose(1, 0, 2))  # (bytes, languages, windows)
        d_out = np.einsum("tlw,tsw->ls", d, states, optimize=True)
        d_bias = d.sum(axis=(0, 2))[:, None]
        d_states = np.matmul(self.out.T, d)
        d_in_f, d_own_f = self.back(self.in_f, self.own_f, symbols, kept_f, d_states[:, :n])
        d_in_b, d_own_b = self.back(
            self.in_b, self.own_b, symbols[::-1], kept_b, d_states[::-1, n:]
        )
        loss = float(-np.log(np.maximum(right, 1e-9)).mean())
        return loss, [d_in_f, d_in_b, d_own_f, d_own_b, d_out, d_bias]

    def pooled(self, bodies: list[bytes]) -> np.ndarray:
        """(texts, languages): mean chances over all bytes of each text."""
        sums = np.zeros((len(bodies), len(self.languages)))
        pieces = [windows(body) for body in bodies]
        rows = np.concatenate([p[0] for p in pieces])
        new = np.concatenate([p[1] for p in pieces])
        owner = np.repeat(np.arange(len(bodies)), [len(p[1]) for p in pieces])
        # Weight of byte t in a window: whether it is new there.
        place = np.arange(WIDTH)
        for low in range(0, len(rows), TOGETHER):
            some = slice(low, low + TOGETHER)
            found = self.label(rows[some])
            counts = (place[:, None] >= WIDTH - new[some]).astype("f4")
            np.add.at(sums, owner[some], np.einsum("ltw,tw->wl", found, counts))
        return sums / np.bincount(owner, new, len(bodies))[:, None]


def train(languages: list[str], rows: np.ndarray, language: np.ndarray) -> Network:
    """Adam over shuffled batches of labelled windows."""
    network, draw = Network(languages), np.random.default_rng(SEED)
    first = [np.zeros_like(w) for w in network.weights()]
    second = [np.zeros_like(w) for w in network.weights()]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = draw.permutation(len(rows))
        for low in range(0, len(order), BATCH):
            some = order[low : low + BATCH]
            _, found = network.gradients(rows[some], language[some])
            norm = float(np.sqrt(sum(float((g * g).sum()) for g in found)))
            step += 1
            for w, g, m, v in zip(network.weights(), found, first, second):
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def sample(
    df: DataFrame, lang_col: str, text_col: str, id_col: str, docs: int, per_doc: int
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and their language's number: at most ``docs`` documents of each
    language, chosen by a hash over all of them, and ``per_doc`` windows of each, from
    places all over its text."""
    rows = texts(df, id_col, text_col, column(lang_col).cast("string").alias("lang"))
    rows = rows.where("lang is not null").withColumn("draw", F.xxhash64("id", "body"))
    counts = stage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n_of")))
    if counts.count() <= BROADCAST_LANGUAGES:
        counts = F.broadcast(counts)
    # Some more than asked for are let through, then the smallest draws are taken.
    share = F.lit(2.0 * docs) / F.col("n_of")
    spread = F.pmod("draw", F.lit(1 << 20)) / F.lit(float(1 << 20))
    order = Window.partitionBy("lang").orderBy(spread, "draw", "id")
    chosen = rows.join(counts, "lang").where((F.col("n_of") <= 2 * docs) | (spread < share))
    chosen = chosen.withColumn("place", F.row_number().over(order)).where(F.col("place") <= docs)

    def run(batches):
        for batch in batches:
            out = []
            columns = [batch.column(n).to_pylist() for n in ("lang", "draw", "body")]
            for lang, draw, body in zip(*columns):
                if has_letter(body):
                    found, _ = windows(body)
                    places = np.random.default_rng(draw & 0xFFFFFFFF).permutation(len(found))
                    out += [(lang, draw, i, found[p].tobytes()) for i, p in enumerate(places[:per_doc])]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kinds[i]) for i in range(4)],
                names=["lang", "draw", "i", "window"],
            )

    found = chosen.select("lang", "draw", "body").mapInArrow(
        run, "lang string, draw long, i int, window binary"
    )
    found = sorted(tuple(r) for r in found.collect())  # docs * per_doc windows of a language
    languages = sorted({r[0] for r in found})
    data = np.frombuffer(b"".join(bytes(r[3]) for r in found), np.uint8).reshape(-1, WIDTH)
    number = {name: i for i, name in enumerate(languages)}
    return languages, data, np.array([number[r[0]] for r in found], np.int64)


def predict(
    df: DataFrame, network: Network | None, id_col: str, text_col: str, *more: Column
) -> DataFrame:
    """(id, lang_pred, score, more...) for every row; further columns keep whatever name they have."""
    rows = texts(df, id_col, text_col, *([F.struct(*more).alias("more")] if more else []))
    schema = T.StructType.fromDDL("id long, lang_pred string, score double")
    schema = T.StructType(schema.fields + rows.schema.fields[2:])
    further = rows.columns[2:]
    shared = df.sparkSession.sparkContext.broadcast(network)

    def make():
        def work(batch):
            model = shared.value
            bodies = batch.column("body").to_pylist()
            label, score = [UNKNOWN] * len(bodies), [0.0] * len(bodies)
            known = [i for i, b in enumerate(bodies) if model is not None and has_letter(b)]
            if known:
                found = model.pooled([bodies[i] for i in known])
                for i, chances in zip(known, found):
                    best = int(chances.argmax())
                    label[i], score[i] = model.languages[best], min(1.0, float(chances[best]))
            return {
                "id": batch.column("id"),
                "lang_pred": label,
                "score": score,
            } | {name: batch.column(name) for name in further}

        return work

    out = per_batch(rows, schema, make)
    return out.select(F.col("id").alias(id_col), "lang_pred", "score", *(["more.*"] if more else []))


def identify(
    df: DataFrame,
    learn_from: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_windows: int = SAMPLE_WINDOWS,
    more: tuple[Column, ...] = (),
) -> DataFrame:
    """(id, lang_pred, score, more...): language of every whole text, and its chance.

    The network learns from the texts and languages of ``learn_from`` alone: at most
    ``sample_docs`` documents of each language and ``sample_windows`` windows of each. Null
    languages are not learned from. A text without a letter is ``und`` with score 0, and so
    is every text if nothing could be learned. Repeated rows stay repeated.
    """
    languages, rows, number = sample(
        learn_from, lang_col, text_col, id_col, sample_docs, sample_windows
    )
    network = train(languages, rows, number) if languages else None
    return predict(df, network, id_col, text_col, *more)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, by the number of folds; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(column(id_col).cast("string"), F.lit(""))), F.lit(folds))


def fold_of(value: int | None, folds: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % folds
