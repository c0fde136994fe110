"""Language identification in two steps: the family first, then one-against-one linear SVMs inside it.

Features are hashed runs of two and three bytes of the lower-cased whole text, square roots of their counts, scaled to
length one. Each family has a linear SVM against the rest; each pair of languages of one family has one of its own.
Training takes at most ``SAMPLE`` distinct labelled texts of each language, those with the least hashes, and at most
``MAX_SAMPLES`` in all, so the sample has a bound that does not grow with the table. A count of distinct texts gives
the hash below which each language's sample lies, so only about twice the sample leaves the scan. Prediction is one
narrow pass.

Defined cases: a null text or one without a letter is ``und`` with score 0; without labelled rows everything is
``und``; a null doc_id counts as the empty text for the split (held out); a language outside the table of families is
a family of its own; repeated rows are predicted alike; languages with equal votes go to the larger sum of margins,
then to the name that sorts first.

``predicted(..., reject=True)`` also gives ``und`` to texts in no learnt language. The votes cannot tell, since one of
two always wins. So each language has a profile, the logarithm of how much likelier its runs of bytes are than any; a
text goes if its mean over the best profile lies below its language's limit by enough evidence. The limit comes from
halves of the sample held against each other's profiles. Defined cases: a language with too few samples for a limit
rejects nothing; so does a text too short for the evidence; a language much like a learnt one may pass for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from battlelake.llm import bytesets

#: Labelled texts of each language that are learnt from, at most, languages learnt at most (the most frequent), and texts in all
#: (16 KB each on the driver).
SAMPLE, MAX_LANGUAGES, MAX_SAMPLES = 400, 200, 16_000

#: Features, and texts whose features a task holds at a time (4 MB, in a few copies).
BUCKETS, SLICE_ROWS = 4096, 256

UNDETERMINED = "und"

#: The size of the SVMs' first steps.
STEP = 20

#: Samples that a language's limit needs, and the part of the 0.01 quantile of their scores that it is: texts of several
#: languages and names stay. A text is rejected by this much log-likelihood.
LEAST_SAMPLES, LIMIT_SHARE, EVIDENCE = 10, 0.25, 10.0

#: Families of language codes. Fixed values.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk tr uz",
    "indic": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
    "chinese": "wuu yue zh",
}


def family_of(lang: str) -> str:
    code = lang.lower().split("-")[0]
    return next((family for family, codes in FAMILIES.items() if code in codes.split()), f"other {lang}")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and Latin-1 letters; other ASCII signs become blanks."""
    out = bytesets.LOWER[data]
    after_c3 = np.zeros(len(out), bool)
    after_c3[1:] = out[:-1] == 0xC3
    out[after_c3 & (out >= 0x80) & (out <= 0x9E)] += 0x20
    out[(out < 0x80) & ((out < ord("a")) | (out > ord("z")))] = 0x20
    return out


def feature_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``BUCKETS`` features for each text."""
    codes = folded(data).astype(np.uint32)
    out = np.zeros((len(offsets) - 1, BUCKETS), np.float32)
    pairs = codes[:-1] | codes[1:] << np.uint32(8) if len(codes) > 1 else codes[:0]
    triples = pairs[:-1] | codes[2:] << np.uint32(16) if len(codes) > 2 else codes[:0]
    hashed = []
    for width, grams in ((2, pairs), (3, triples)):
        mixed = (grams + np.uint32(width << 24)) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x85EBCA77)
        hashed.append((width, (mixed >> np.uint32(20)).astype(np.int32)))
    for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        for width, grams in hashed:
            if b - a >= width:
                out[row] += np.bincount(grams[a:b - width + 1], minlength=BUCKETS)
    np.sqrt(out, out=out)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norm, 1e-9)


def gram_shares(rows: np.ndarray) -> np.ndarray:
    """The share of each feature in its text, without the runs of blanks."""
    shares = rows.astype(np.float32) ** 2
    shares[:, feature_rows(np.full(3, 0x20, np.uint8), np.array([0, 3]))[0] > 0] = 0
    return shares / np.maximum(shares.sum(axis=1, keepdims=True), 1e-9)


def signs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bytes of each text that are not blanks once folded."""
    return np.diff(np.concatenate(([0], np.cumsum(folded(data) != 0x20)))[offsets])


def profile(shares: np.ndarray) -> np.ndarray:
    """How much likelier each feature is in these texts than an even share, as a logarithm."""
    return np.log(0.9 * BUCKETS * shares.mean(axis=0) + 0.1).astype(np.float32)


def _limit(shares: np.ndarray) -> float:
    """What clean texts of one language stay above, from halves that are held out from each other's profile."""
    if len(shares) < LEAST_SAMPLES:
        return -np.inf
    a, b = shares[::2], shares[1::2]
    low = np.quantile(np.concatenate((a @ profile(b), b @ profile(a))), 0.01)
    return float(low) * LIMIT_SHARE if low > 0 else -np.inf


def _svm(rows: np.ndarray, side: np.ndarray, epochs: int = 20) -> np.ndarray:
    """Weights, bias last, of a linear SVM fitted by averaged stochastic subgradients in a fixed order."""
    x = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
    order = np.random.RandomState(7)
    # Both sides weigh the same, whatever their numbers.
    share = {s: len(side) / (2 * max(1, (side == s).sum())) for s in (-1, 1)}
    w, total, steps, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0, 100
    for epoch in range(epochs):
        for i in order.permutation(len(x)):
            t += 1
            w *= 1 - 1 / t
            if side[i] * (x[i] @ w) < 1:
                w += share[side[i]] * side[i] * (STEP / t**0.5) * x[i]
            if epoch >= epochs // 2:
                total += w
                steps += 1
    return (total / max(1, steps)).astype(np.float32)


@dataclass
class Model:
    """What is learnt; its size depends on the number of languages alone."""

    families: list[str]
    members: dict[str, list[str]]
    family_weights: np.ndarray
    pair_weights: dict[tuple[str, str], np.ndarray]
    profiles: np.ndarray
    limits: dict[str, float]

    @classmethod
    def fitted(cls, rows: np.ndarray, langs: list[str]) -> Model:
        own = np.array([family_of(x) for x in langs])
        names = np.array(langs)
        families = sorted(set(own.tolist()))
        members = {f: sorted(set(names[own == f].tolist())) for f in families}
        weights = [_svm(rows, np.where(own == f, 1, -1)) for f in families] if len(families) > 1 else [np.zeros(BUCKETS + 1)] * len(families)
        pairs = {}
        for langs_in in members.values():
            for i, a in enumerate(langs_in):
                for b in langs_in[i + 1:]:
                    chosen = (names == a) | (names == b)
                    pairs[a, b] = _svm(rows[chosen], np.where(names[chosen] == a, 1, -1))
        shares = gram_shares(rows)
        own = {lang: shares[names == lang] for lang in sorted(set(langs))}
        profiles = np.array([profile(x) for x in own.values()], np.float32).reshape(len(own), BUCKETS)
        return cls(families, members, np.array(weights, np.float32).reshape(len(families), BUCKETS + 1), pairs,
                   profiles, {lang: _limit(x) for lang, x in own.items()})

    def unlike(self, rows: np.ndarray, langs: list[str], sizes: np.ndarray) -> np.ndarray:
        """Which texts of ``sizes`` signs are in no learnt language; ``langs`` has what was predicted."""
        if not self.families:
            return np.zeros(len(rows), bool)
        best = (gram_shares(rows) @ self.profiles.T).max(axis=1)
        # Each sign begins a run of two and one of three.
        return 2 * np.maximum(sizes, 1) * (np.array([self.limits[x] for x in langs]) - best) >= EVIDENCE

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return [UNDETERMINED] * len(rows), np.zeros(len(rows))
        sure = lambda margin: 1 / (1 + np.exp(-2 * np.clip(margin, -20, 20)))
        margins = rows @ self.family_weights[:, :-1].T + self.family_weights[:, -1]
        chosen = margins.argmax(axis=1)
        score = sure(margins[np.arange(len(rows)), chosen]) if len(self.families) > 1 else np.ones(len(rows))
        out = np.empty(len(rows), object)
        for f, family in enumerate(self.families):
            at = np.flatnonzero(chosen == f)
            langs = self.members[family]
            votes, sums = np.zeros((len(at), len(langs))), np.zeros((len(at), len(langs)))
            for i, a in enumerate(langs):
                for j in range(i + 1, len(langs)):
                    w = self.pair_weights[a, langs[j]]
                    margin = rows[at] @ w[:-1] + w[-1]
                    votes[:, i] += margin >= 0
                    votes[:, j] += margin < 0
                    sums[:, i] += margin
                    sums[:, j] -= margin
            best = (votes + 1e-3 * np.tanh(sums)).argmax(axis=1)
            for k, row in enumerate(at):
                out[row] = langs[best[k]]
                if len(langs) > 1:
                    score[row] *= sure(sums[k, best[k]] / (len(langs) - 1))
        return out.tolist(), score


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from rows (text, lang) with both present; the caller chooses which rows may be learnt from."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("code"))
    frequent = usable.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("code").alias("texts")).orderBy(
        F.col("n").desc(), "lang").limit(MAX_LANGUAGES).collect()
    each = min(sample, MAX_SAMPLES // max(1, len(frequent)))
    # Hashes are uniform: the least 1 / k of them belong to about texts / k texts, and twice the sample leaves room for chance.
    limits = docs.sparkSession.createDataFrame(
        [(r["lang"], min(2**63 - 1, int(2**64 * (2 * each + 100) / max(1, r["texts"])) - 2**63)) for r in frequent], "lang string, most long")
    below = usable.join(F.broadcast(limits), "lang").where(F.col("code") <= F.col("most"))
    by_hash = Window.partitionBy("lang").orderBy("code")
    once = below.groupBy("lang", "code").agg(F.first("text").alias("text"))
    chosen = once.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= each).select("lang", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytesets.slices(batch, "text"):
                rows = feature_rows(*bytesets.texts_of(part.column("text")))
                packed = [np.round(r * 65535 / max(r.max(initial=0), 1e-9)).astype("<u2").tobytes() for r in rows]
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(packed, pa.binary())], names=["lang", "row"])

    # At most ``MAX_SAMPLES`` rows of 8 KB.
    rows = sorted((r["lang"], bytes(r["row"])) for r in bytesets.map_arrow(chosen, features, "lang string, row binary").toLocalIterator())
    matrix = np.frombuffer(b"".join(r for _, r in rows), "<u2").reshape(len(rows), BUCKETS).astype(np.float32)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    return Model.fitted(matrix, [lang for lang, _ in rows])


def predicted(docs: DataFrame, model: Model, text: str = "text", reject: bool = False) -> tuple[DataFrame, str, str]:
    """All columns and two more, the language and its score; also their names. ``reject``: see the module."""
    import pyspark.sql.types as T

    lang, score = bytesets.free_name(docs, "lang_pred"), bytesets.free_name(docs, "score")
    schema = T.StructType([*docs.schema.fields]).add(lang, T.StringType()).add(score, T.DoubleType())
    known = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    letters = np.zeros(256, bool)
    letters[0x41:0x5B] = letters[0x61:0x7B] = True

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        own = known.value
        for batch in batches:
            named = pa.RecordBatch.from_arrays(batch.columns, names=[str(i) for i in range(batch.num_columns)])
            for part in (p.slice(i, SLICE_ROWS) for p in bytesets.slices(named, str(at)) for i in range(0, p.num_rows, SLICE_ROWS)):
                data, offsets = bytesets.texts_of(part.column(at))
                rows = feature_rows(data, offsets)
                langs, scores = own.predict(rows)
                if reject:
                    for row in np.flatnonzero(own.unlike(rows, langs, signs(data, offsets))):
                        langs[row] = UNDETERMINED
                plain = np.concatenate(([0], np.cumsum(letters[data])))
                for row in np.flatnonzero(np.diff(plain[offsets]) == 0):
                    if not regex.search(r"\p{L}", data[offsets[row]:offsets[row + 1]].tobytes().decode("utf-8", "replace")):
                        langs[row], scores[row] = UNDETERMINED, 0.0
                scores = [0.0 if x == UNDETERMINED else float(s) for x, s in zip(langs, scores, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return bytesets.map_arrow(docs, predict, schema), lang, score


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learnt from the rows that are not held out."""
    rows = bytesets.only(docs, doc_id="bigint", text="string", lang="string")
    model = train(rows.where(~held_out(F.col("doc_id"))))
    found, lang, score = predicted(rows.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(lang).alias("lang_pred"), F.col(score).alias("score"))
