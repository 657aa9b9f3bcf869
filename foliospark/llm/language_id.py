"""Language identification in two steps: the family first, then the language in it.

A linear classifier (one against the rest) chooses the family; inside a family
of several languages each pair has a linear support vector machine, and the
language with most votes wins (ties: larger sum of margins, then name).  Inputs
are hashed letter n-grams of the whole text, so nothing but the text counts.

The classifiers are fitted on a bounded sample (``max_rows``) of labelled rows;
every language gets the same share of it.  Rows are chosen by a hash of their
id, so the sample is the same in every run.

A null text, or one without a letter, is ``und`` with score 0.  Labels that are
null are not learnt; without labelled rows everything is ``und``.  Rows with
repeated or null ids are predicted one by one; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_loop, give_back

UNKNOWN = "und"
#: Language families; a language that is not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic", "bg": "slavic", "sk": "slavic",
}
WIDTH = 1 << 12
LETTER = re.compile(r"[^\W\d_]")
_TO_BLANK = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def features(texts: list[str], width: int = WIDTH) -> np.ndarray:
    """Unit vectors of the square roots of the counts of hashed 1-, 2-, 3- and 4-byte strings, a row for each text."""
    raw = [(" " + t.lower() + " ").encode("utf-8", "replace").translate(_TO_BLANK) for t in texts]
    out = np.zeros((len(raw), width), np.float32)
    start = 0
    while start < len(raw):
        end, size = start, 0
        while end < len(raw) and (end == start or size + len(raw[end]) <= 4 << 20):
            size += len(raw[end])
            end += 1
        data = np.frombuffer(b"".join(raw[start:end]), np.uint8)
        row = np.repeat(np.arange(end - start, dtype=np.int64) * width, [len(r) for r in raw[start:end]])
        gram = data.astype(np.uint32)
        for n in range(1, 5):
            if n > 1:
                gram = gram[:-1] * np.uint32(0x01000193) ^ data[n - 1 :]
            mixed = (gram ^ np.uint32(n)) * np.uint32(0x9E3779B1)
            place = row[: len(gram)] + (mixed >> np.uint32(32 - int(width - 1).bit_length()))
            out[start:end] += np.bincount(place, minlength=(end - start) * width).reshape(end - start, width)
        start = end
    np.sqrt(out, out=out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 80) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine with squared hinge loss; ``y`` is 1 or -1.

    Both classes weigh alike.  Accelerated gradient steps over all rows.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = ahead = np.zeros(x.shape[1], np.float32)
    rate, pace = np.float32(1 / (4 + penalty)), 1.0
    for _ in range(steps):
        gap = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - rate * (penalty * ahead - 2 * (x.T @ (share * gap * y)))
        following = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead = new + np.float32((pace - 1) / following) * (new - w)
        w, pace = new, following
    return w


def _sure(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-4 * np.clip(margin, -20, 20)))


class Model:
    """Family and pair machines; a few vectors, so it is sent to every task."""

    def __init__(self, x: np.ndarray, langs: list[str], families: dict[str, str]):
        self.langs = sorted(set(langs))
        family = {lang: families.get(lang, lang) for lang in self.langs}
        self.families = sorted(set(family.values()))
        of = np.array([self.langs.index(lang) for lang in langs], int)
        group = np.array([self.families.index(family[lang]) for lang in langs], int)
        sign = lambda hit: np.where(hit, 1, -1).astype(np.float32)
        self.family_w = [fit_svm(x, sign(group == f)) for f in range(len(self.families))] if len(self.families) > 1 else []
        self.members = [[i for i, lang in enumerate(self.langs) if family[lang] == f] for f in self.families]
        self.pair_w = {}
        for members in self.members:
            for a, b in combinations(members, 2):
                both = (of == a) | (of == b)
                self.pair_w[a, b] = fit_svm(x[both], sign(of[both] == a))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        if self.family_w:
            margins = x @ np.stack(self.family_w, axis=1)
            family, score = margins.argmax(axis=1), _sure(margins.max(axis=1))
        else:
            family, score = np.zeros(len(x), int), np.ones(len(x))
        lang = np.zeros(len(x), int)
        for f, members in enumerate(self.members):
            rows = np.flatnonzero(family == f)
            if len(members) == 1:
                lang[rows] = members[0]
                continue
            votes = np.zeros((len(rows), len(members)))
            for (a, b), w in ((p, w) for p, w in self.pair_w.items() if p[0] in members):
                margin = x[rows] @ w
                i, j = members.index(a), members.index(b)
                # A vote counts 1000; the margins decide between equal numbers of votes.
                votes[:, i] += 1000.0 * (margin >= 0) + np.clip(margin, -20, 20)
                votes[:, j] += 1000.0 * (margin < 0) - np.clip(margin, -20, 20)
            best = votes.argmax(axis=1)
            lang[rows] = np.array(members)[best]
            for i in range(len(members)):
                won = best == i
                for k in range(len(members)):
                    if k != i and won.any():
                        a, b = sorted((members[i], members[k]))
                        margin = x[rows[won]] @ self.pair_w[a, b]
                        score[rows[won]] *= _sure(margin if members[i] == a else -margin)
        return [self.langs[i] for i in lang], score


def fit(docs: DataFrame, learn: Column, families: dict[str, str] = FAMILIES, max_rows: int = 2400) -> Model | None:
    """The machines learnt from at most about ``max_rows`` rows that satisfy ``learn``, shared equally by the languages."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    each = max(1, max_rows // len(counts))
    shares = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, float(each) / n)])
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(draw < F.try_element_at(shares, F.col("lang"))).select("lang", F.col("text").cast("string").alias("text"))

    def make():
        def step(batch):
            x = features(batch.column("text").to_pylist())
            place = [np.flatnonzero(r).astype("<u2") for r in x]
            value = [r[p].astype("<f4") for r, p in zip(x, place)]
            return pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([p.tobytes() for p in place]), pa.array([v.tobytes() for v in value])], ["lang", "place", "value"])

        return step

    found = sorted((r["lang"], bytes(r["place"]), bytes(r["value"])) for r in sample.mapInArrow(arrow_loop(make), "lang string, place binary, value binary").collect())
    if not found:
        return None
    x = np.zeros((len(found), WIDTH), np.float32)
    for i, (_, place, value) in enumerate(found):
        x[i, np.frombuffer(place, "<u2")] = np.frombuffer(value, "<f4")
    model = Model(x, [lang for lang, _, _ in found], families)
    # Else the driver keeps what the matrices took while the next stages run.
    x = found = None
    give_back()
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text."""

    def make():
        def step(batch):
            given = batch.column("text").to_pylist()
            known = [i for i, t in enumerate(given) if model is not None and t is not None and LETTER.search(t)]
            langs, scores = [UNKNOWN] * len(given), np.zeros(len(given))
            if known:
                found, sure = model.predict(features([given[i] for i in known]))
                scores[known] = sure
                for i, lang in zip(known, found):
                    langs[i] = lang
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

        return step

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(arrow_loop(make, 256), "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model | None, least_score: float = 0.25) -> DataFrame:
    """``docs`` without the rows whose language is not recognised: ``und``, or a score below ``least_score``.

    A null ``lang`` becomes the predicted one; all other columns stay as they are.
    """

    def make():
        def step(batch):
            given = batch.column("text").to_pylist()
            langs = [UNKNOWN] * len(given)
            known = [i for i, t in enumerate(given) if model is not None and t is not None and LETTER.search(t)]
            if known:
                for i, lang, score in zip(known, *model.predict(features([given[i] for i in known]))):
                    langs[i] = lang if score >= least_score else UNKNOWN
            at = batch.schema.get_field_index("lang")
            filled = [a if a is not None else b for a, b in zip(batch.column(at).to_pylist(), langs)]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(filled, pa.string()))
            return batch.filter(pa.array([lang != UNKNOWN for lang in langs]))

        return step

    return docs.mapInArrow(arrow_loop(make, 256), docs.schema)
