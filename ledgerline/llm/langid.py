"""Language identification by a byte convolutional network, trained in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes (the last one is
padded). Bytes become small vectors; filters of several widths slide over
them; each filter's largest response in the window goes through a ReLU into a
softmax over the languages. A document's probabilities are the mean of its
windows' weighted by their bytes: the whole text counts.

The network learns from a bounded sample of labelled rows. For use, every
filter tap is folded into a table with a row for each byte value, so that a
filter bank is a sum of table lookups over a batch of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import columns, fresh, hash_bound, hash_order, held_out, train_row

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
TRAIN_ROWS = 4000
EPOCHS = 8
MIN_STEPS = 400
BATCH = 64
RATE = 0.01
MIN_SCORE = 0.4
UNKNOWN = "und"
_WINDOWS_AT_ONCE = 256


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray  # (256, EMBED)
    taps: list[np.ndarray]  # for each width: (width, EMBED, FILTERS)
    shift: np.ndarray  # (len(WIDTHS) * FILTERS,)
    out: np.ndarray  # (len(WIDTHS) * FILTERS, languages)
    out_shift: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """For each width and tap, the filters' responses to each byte value."""
        return [[np.ascontiguousarray(self.embed @ tap) for tap in bank] for bank in self.taps]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _adam(grads: list[np.ndarray], params: list[np.ndarray], state: list[list[np.ndarray]], step: int) -> None:
    for p, g, (m, v) in zip(params, grads, state):
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy of windows ``x`` with label numbers ``y`` by the network's parameters:
    embed, each width's taps, shift, out, out_shift."""
    at = np.arange(len(x))[:, None]
    vectors = net.embed[x]
    peaks, top = [], []
    for bank in net.taps:
        span = WINDOW - len(bank) + 1
        heard = sum(vectors[:, j : j + span] @ tap for j, tap in enumerate(bank))
        top.append(heard.argmax(1))
        peaks.append(np.take_along_axis(heard, top[-1][:, None], 1)[:, 0])
    pooled = np.concatenate(peaks, 1) + net.shift
    live = np.maximum(pooled, 0)
    error = _softmax(live @ net.out + net.out_shift)
    error[np.arange(len(x)), y] -= 1
    error /= len(x)
    back = (error @ net.out.T) * (pooled > 0)
    d_embed = np.zeros_like(net.embed)
    d_taps = []
    for b, bank in enumerate(net.taps):
        g = back[:, b * FILTERS : (b + 1) * FILTERS]
        d_bank = np.zeros_like(bank)
        for j, tap in enumerate(bank):
            place = top[b] + j  # (rows, FILTERS): where each filter peaked
            d_bank[j] = np.einsum("rf,rfe->ef", g, vectors[at, place])
            np.add.at(d_embed, x[at, place], g[:, :, None] * tap.T[None])
        d_taps.append(d_bank)
    return [d_embed, *d_taps, back.sum(0), live.T @ error, error.sum(0)]


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 5) -> Network:
    """Train on windows (n, WINDOW) of bytes with label numbers, by Adam on the cross
    entropy: EPOCHS passes, or as many as make MIN_STEPS steps."""
    rng = np.random.default_rng(seed)
    k, n = len(WIDTHS) * FILTERS, len(languages)
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        [rng.normal(0, (w * EMBED) ** -0.5, (w, EMBED, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(k, np.float32),
        rng.normal(0, k**-0.5, (k, n)).astype(np.float32),
        np.zeros(n, np.float32),
    )
    params = [net.embed, *net.taps, net.shift, net.out, net.out_shift]
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    step = 0
    for _ in range(max(EPOCHS, -(-MIN_STEPS * BATCH // len(windows)))):
        order = rng.permutation(len(windows))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            step += 1
            _adam(gradients(net, windows[rows], labels[rows]), params, state, step)
    return net


def predict_windows(net: Network, tables: list[list[np.ndarray]], windows: np.ndarray) -> np.ndarray:
    """Probabilities (n, languages) of windows (n, WINDOW)."""
    peaks = []
    for bank in tables:
        span = WINDOW - len(bank) + 1
        heard = bank[0][windows[:, :span]]
        for j in range(1, len(bank)):
            heard += bank[j][windows[:, j : j + span]]
        peaks.append(heard.max(1))
    live = np.maximum(np.concatenate(peaks, 1) + net.shift, 0).astype(np.float64)
    return _softmax(live @ net.out.astype(np.float64) + net.out_shift)


def cut(text: bytes) -> np.ndarray:
    """The windows (n, WINDOW) of a text; the last one is padded with zero bytes."""
    count = max(1, -(-len(text) // WINDOW))
    return np.frombuffer(text.ljust(count * WINDOW, b"\0"), np.uint8).reshape(count, WINDOW)


def predict(net: Network, texts: list[bytes]) -> np.ndarray:
    """Probabilities (texts, languages) to six digits, which don't depend on the texts
    that share a batch."""
    tables = net.tables()
    total = np.zeros((len(texts), len(net.languages)))
    pending: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if pending:
            found = predict_windows(net, tables, np.concatenate([w for _, w in pending]))
            filled = np.concatenate([(w != 0).sum(1) for _, w in pending]) + 1e-9
            owner = np.concatenate([np.full(len(w), i) for i, w in pending])
            np.add.at(total, owner, found * filled[:, None])
            pending.clear()
            held = 0

    for i, text in enumerate(texts):
        windows = cut(text)
        for start in range(0, len(windows), _WINDOWS_AT_ONCE):
            some = windows[start : start + _WINDOWS_AT_ONCE]
            pending.append((i, some))
            held += len(some)
            if held >= _WINDOWS_AT_ONCE:
                flush()
    flush()
    return np.round(total / total.sum(1, keepdims=True), 6)


def training_windows(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(lang, piece) from at most ``train_rows`` labelled training rows.

    Rows with the smallest hash of their id and text are taken in each language in
    equal numbers (the most frequent languages, if there are more than rows). A row gives one stretch of WINDOW characters from a hashed place.
    """
    labelled = docs.where(train_row() & F.col("lang").isNotNull())
    counted = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(train_rows).collect()
    if not counted:
        return docs.select("lang", F.lit("").alias("piece")).limit(0)
    each = max(1, train_rows // len(counted))
    bounds = F.create_map(*[F.lit(x) for lang, n in counted for x in (lang, hash_bound(each, n))])
    order = hash_order("doc_id", "text")
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.lit(1), F.length("text") - WINDOW)) + 1
    pieces = labelled.where((order <= bounds[F.col("lang")]) & F.col("text").rlike(r"\p{L}")).select(
        "lang", order.alias("order"), F.substr("text", place.cast("int"), F.lit(WINDOW)).alias("piece")
    )
    by_hash = Window.partitionBy("lang").orderBy("order", "piece")
    return pieces.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= each).select("lang", "piece")


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Network | None:
    """A network from the labelled training rows; None if there are none."""
    rows = sorted(tuple(r) for r in training_windows(docs, train_rows).collect())
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    rng = np.random.default_rng(3)
    windows, labels = [], []
    for lang, piece in rows:
        raw = piece.encode()[:WINDOW]
        # also learn from short stretches, as short texts have no more
        for part in (raw, raw[: int(rng.integers(8, WINDOW))]):
            windows.append(np.frombuffer(part.ljust(WINDOW, b"\0"), np.uint8))
            labels.append(languages.index(lang))
    return fit(np.stack(windows), np.array(labels), languages)


def identify(docs: DataFrame, net: Network | None, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its probability in two added columns, whose names it must not have.

    A text that is null or has no letter gets ``und`` and 0, and so does every
    text if nothing was learnt. Equal texts get equal results.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("lang string, score double")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            ok = texts.notna().to_numpy() & (sent.value is not None)
            named, sure = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if ok.any():
                found = predict(sent.value, list(texts[ok]))
                named[ok] = np.array(sent.value.languages, object)[found.argmax(1)]
                sure[ok] = np.clip(found.max(1), 0, 1)
            yield pd.DataFrame({"lang": named, "score": sure})

    readable: Column = F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary"))
    both = fresh(docs, "_told")
    out = docs.select(*columns(docs.columns), told(readable).alias(both))
    return out.select(*columns(docs.columns), F.col(f"{both}.lang").alias(lang), F.col(f"{both}.score").alias(score))


def language(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs``.

    Learns from rows with a language that aren't held out, predicts all from
    their text alone. Repeated rows keep their rows; an empty table gives no
    rows; other columns are ignored.
    """
    net = train(docs.select("doc_id", "text", "lang"), train_rows)
    found = identify(docs.select("doc_id", "text"), net)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def drop_unknown_language(docs: DataFrame, train_rows: int = TRAIN_ROWS, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without texts of no learnt language: ``und``, or a probability below ``min_score``.

    Null texts and texts without letters (empty and white-space ones, too) go. Rows with
    equal texts stay or go together, whatever their ids, null ids too. Where there is
    nothing to learn from, every text is ``und`` and goes. An empty table gives no rows;
    other columns pass through, whatever their names.
    """
    lang, score = fresh(docs, "_lang"), fresh(docs, "_score")
    told = identify(docs, train(docs, train_rows), lang, score)
    return told.where((F.col(lang) != UNKNOWN) & (F.col(score) >= min_score)).select(*columns(docs.columns))
