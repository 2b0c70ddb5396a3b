"""Language identification by a byte convolutional network in numpy.

A text is cut into windows of a fixed number of bytes. Filters of several widths run over the bytes
of a window; the largest answer of each filter goes into a softmax over languages. The text's
language has the largest mean probability over all of its windows.

The network is trained on the driver on a bounded sample of labelled windows. In the tasks a filter of
width w is w lookups: the product of byte embedding and filter is a table of 256 rows per offset.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.llm.common import annotate, column, fold, free_name, held_out

WINDOW = 256  # bytes
EMBEDDING = 8
FILTERS = {2: 8, 3: 16, 4: 16}  # width: number of filters
DOCS_PER_LANGUAGE = 1_000  # labelled documents that training takes of a language
WINDOWS_PER_DOC = 2
MOST_LANGUAGES = 500
STEPS = 750  # gradient steps, whatever the number of samples
BATCH = 64
BLOCK = 8  # windows whose filter answers are held at a time
UNKNOWN = "und"

RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


@dataclass
class ByteNetwork:
    """Trained weights and the languages they tell apart, sorted."""

    languages: list[str]
    embedding: np.ndarray = field(repr=False)
    filters: dict[int, np.ndarray] = field(repr=False)
    bias: dict[int, np.ndarray] = field(repr=False)
    dense: np.ndarray = field(repr=False)
    offset: np.ndarray = field(repr=False)

    def tables(self) -> list[list[np.ndarray]]:
        """Per width, per offset: the answer of each filter to each byte."""
        e = self.embedding.shape[1]
        return [
            [np.ascontiguousarray(self.embedding @ w[k * e : (k + 1) * e]) for k in range(width)]
            for width, w in self.filters.items()
        ]


def windows(texts: list[bytes], length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts in rows of ``length``, padded with 0, and the text each row is of."""
    sizes = np.array([len(t) for t in texts], np.int64)
    rows = np.maximum(1, -(-sizes // length))
    flat = np.zeros(int(rows.sum()) * length, np.uint8)
    at = 0
    for t, r in zip(texts, rows.tolist()):
        flat[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += r * length
    return flat.reshape(-1, length), np.repeat(np.arange(len(texts)), rows)


def pooled(x: np.ndarray, tables, bias) -> np.ndarray:
    """Largest answer of every filter in every window, a block of windows at a time."""
    n, length = x.shape
    out = np.empty((n, sum(t[0].shape[1] for t in tables)), np.float32)
    for at in range(0, n, BLOCK):
        block, col = x[at : at + BLOCK], 0
        for table in tables:
            width, count = len(table), table[0].shape[1]
            span = length - width + 1
            total = table[0].take(block[:, :span], axis=0)
            for k in range(1, width):
                total += table[k].take(block[:, k : k + span], axis=0)
            out[at : at + BLOCK, col : col + count] = total.max(axis=1)
            col += count
    return np.maximum(out + np.concatenate(bias), 0)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def predict(texts: list[bytes], net: ByteNetwork, tables) -> tuple[np.ndarray, np.ndarray]:
    """Index and mean probability of the likeliest language of each whole text."""
    x, of = windows(texts)
    p = softmax(pooled(x, tables, [net.bias[w] for w in net.filters]) @ net.dense + net.offset)
    # A window counts by the bytes it holds, so a short rest does not outweigh the others.
    held = np.maximum((x != 0).sum(axis=1), 1).astype(np.float64)
    total = np.zeros((len(texts), p.shape[1]))
    for k in range(p.shape[1]):
        total[:, k] = np.bincount(of, p[:, k] * held, len(texts))
    mean = total / np.bincount(of, held, len(texts))[:, None]
    best = mean.argmax(axis=1)
    return best, np.clip(mean[np.arange(len(texts)), best], 0, 1)


def train(samples: list[tuple[bytes, str]], seed: int = 7) -> ByteNetwork:
    """Fit the network to labelled windows by Adam; the same samples give the same network.

    Half of the windows are shortened to a random length in every epoch, so that short texts are
    known too. Gradients reach a filter only at the place of its largest answer.
    """
    languages = sorted({lang for _, lang in samples})
    rng = np.random.default_rng(seed)
    x, _ = windows([t[:WINDOW] for t, _ in samples])
    y = np.array([languages.index(lang) for _, lang in samples])
    n_filters = sum(FILTERS.values())
    params = {"e": rng.normal(0, 0.5, (256, EMBEDDING)), "d": rng.normal(0, 0.1, (n_filters, len(languages))), "o": np.zeros(len(languages))}
    for w, f in FILTERS.items():
        params[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, f))
        params[f"b{w}"] = np.zeros(f)
    params = {k: v.astype(np.float32) for k, v in params.items()}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    step, size = 0, np.maximum((x != 0).sum(axis=1), 1)
    while step < STEPS:
        short = np.where(rng.random(len(x)) < 0.5, rng.integers(6, WINDOW, len(x)), WINDOW)
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH)[: STEPS - step]:
            rows = order[at : at + BATCH]
            xb = np.where(np.arange(WINDOW)[None, :] < np.minimum(short, size)[rows, None], x[rows], 0)
            grads = _gradients(xb, y[rows], params)
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                params[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return ByteNetwork(
        languages,
        params["e"],
        {w: params[f"w{w}"] for w in FILTERS},
        {w: params[f"b{w}"] for w in FILTERS},
        params["d"],
        params["o"],
    )


def _gradients(x: np.ndarray, y: np.ndarray, params: dict) -> dict:
    n, e = len(x), EMBEDDING
    embedded = params["e"][x]  # n, window, e
    tops, places = [], {}
    for w, f in FILTERS.items():
        span = WINDOW - w + 1
        answer = np.zeros((n, span, f), np.float32)
        for k in range(w):
            answer += embedded[:, k : k + span] @ params[f"w{w}"][k * e : (k + 1) * e]
        places[w] = answer.argmax(axis=1)
        tops.append(np.take_along_axis(answer, places[w][:, None, :], axis=1)[:, 0] + params[f"b{w}"])
    h = np.concatenate(tops, axis=1)
    active = np.maximum(h, 0)
    p = softmax(active @ params["d"] + params["o"])
    p[np.arange(n), y] -= 1
    p /= n
    grads = {"d": active.T @ p, "o": p.sum(axis=0), "e": np.zeros_like(params["e"])}
    dh = (p @ params["d"].T) * (h > 0)
    col = 0
    for w, f in FILTERS.items():
        g = dh[:, col : col + f]
        col += f
        grads[f"b{w}"] = g.sum(axis=0)
        gw = np.zeros_like(params[f"w{w}"])
        for k in range(w):
            at = places[w] + k  # n, f
            byte = np.take_along_axis(x, at, axis=1)
            part = params[f"w{w}"][k * e : (k + 1) * e]  # e, f
            gw[k * e : (k + 1) * e] = np.einsum("nfe,nf->ef", params["e"][byte], g)
            np.add.at(grads["e"], byte.ravel(), (g[:, :, None] * part.T[None]).reshape(-1, e))
        grads[f"w{w}"] = gw
    return grads


def labelled_windows(docs: DataFrame, id_col: str, text: str, lang: str, per_language: int, most_languages: int = MOST_LANGUAGES) -> list[tuple[bytes, str]]:
    """A bounded sample of labelled windows of documents outside the held-out fold.

    Of each language, about ``per_language`` documents are drawn by a hash of their text; of each, two
    windows at places the hash names. Of more than ``most_languages`` languages, those with the most
    documents are learned.
    """
    known = docs.where(column(lang).isNotNull() & column(text).isNotNull() & ~held_out(column(id_col)))
    known = known.select(column(text).alias("text"), column(lang).cast("string").alias("lang"), F.xxhash64(column(text)).alias("h"))
    known = known.where(F.col("text").rlike(r"\p{L}"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    if not counts:
        return []
    rate = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, per_language / r["count"])))])
    drawn = known.where(F.pmod("h", F.lit(1_000_003)) < F.coalesce(rate[F.col("lang")], F.lit(0.0)) * 1_000_003)
    room = F.greatest(F.lit(1), F.char_length("text") - WINDOW // 2)
    piece = lambda k: F.substring("text", (F.pmod(F.xxhash64("h", F.lit(k)), room) + 1).cast("int"), F.lit(WINDOW))
    rows = (
        drawn.select("lang", F.explode(F.array(*[piece(k) for k in range(WINDOWS_PER_DOC)])).alias("piece"))
        .orderBy(F.xxhash64("piece"), "lang", "piece")
        .limit(2 * WINDOWS_PER_DOC * per_language * len(counts))
        .collect()
    )
    return [(r["piece"].encode(), r["lang"]) for r in rows]


def fit(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = DOCS_PER_LANGUAGE, most_languages: int = MOST_LANGUAGES) -> ByteNetwork | None:
    """A network trained on a sample of ``docs`` (see ``labelled_windows``); None if no row has a label."""
    samples = labelled_windows(docs, id_col, text, lang, per_language, most_languages)
    return train(samples) if samples else None


def identify(docs: DataFrame, net: ByteNetwork | None, *, text: str = "text", keep: list[str] | None = None, result: str = "language") -> DataFrame:
    """Rows with a struct ``result``: ``lang_pred`` and ``score`` of the whole text; a map.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if there is no
    network. Only the text is an input.
    """
    name = free_name(docs, result)

    def make():
        tables = net.tables() if net else []

        def compute(texts):
            out = {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)}
            rows = [i for i, t in enumerate(texts) if t and has_letter(t)] if net else []
            if rows:
                best, score = predict([texts[i] for i in rows], net, tables)
                for i, b, s in zip(rows, best.tolist(), score.tolist()):
                    out["lang_pred"][i], out["score"][i] = net.languages[b], s
            return out

        return compute

    return annotate(docs, text, make, RESULT, name, keep)


_ASCII_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))


def has_letter(text: bytes) -> bool:
    """True if any character of the text is a letter of any script."""
    if text[:64].strip(_ASCII_LETTERS) != text[:64] or len(text.translate(None, _ASCII_LETTERS)) < len(text):
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def language_table(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document.

    Null texts and texts without a letter are ``und`` with score 0; a row with a null id is not learned
    from. Very long texts are scored whole, window by window; repeated rows get equal results; clashing
    columns are not read; an empty table gives an empty result. Without any label all texts are ``und``.
    """
    net = fit(docs, per_language=per_language)
    found = identify(docs.select("doc_id", "text"), net, keep=["doc_id"], result="language")
    return found.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        F.col("language.lang_pred").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def keep_identified(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.3) -> DataFrame:
    """Rows whose language is told with a score of at least ``least``; columns stay.

    Rejected are texts that are null or without a letter, and texts whose likeliest language has a
    smaller mean probability. If no row has a label there is nothing to tell languages by: then all
    texts with a letter stay. Long texts are scored whole, repeated rows are kept or rejected together,
    clashing names stay as they are, an empty table gives an empty result.
    """
    name = free_name(docs, "language")
    net = fit(docs, id_col=id_col, text=text, lang=lang)
    if net is None:
        return docs.where(F.coalesce(column(text).rlike(r"\p{L}"), F.lit(False)))
    found = identify(docs, net, text=text, result=name)
    language = column(name)
    return found.where((language["lang_pred"] != UNKNOWN) & (language["score"] >= least)).drop(name)
