"""Language identification by character models with interpolated Kneser-Ney smoothing.

One model per language over the letters of words: the history of a character starts
at the word's beginning, so the score of a word is the same wherever it stands and is
computed once per task for each distinct word. The language with the lowest
cross-entropy per character is chosen; a text whose best cross-entropy lies above
what that language's own texts of this length reach is rejected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import InitVar, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload.llm.common import Texts, WordIndex, chunks, hand_back, share_below, utf8

ORDER = 5
#: Of each language so many distinct texts (about) are learned from, chosen by their hash.
SAMPLE_DOCS = 5_000
#: Nats per character, over the root of a text's characters, that its cross-entropy may lie
#: above the limit of a language; nats, over the root of the texts the limit comes from, that
#: are added to it.
MARGIN, SLACK = 4.0, 1.5
UNDETERMINED = "und"
BEGIN, END = "\x02", "\x03"
LETTERS = r"\p{L}[\p{L}\p{M}]*"
_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Distinct words that a task keeps the scores of, and bytes of text scored at a time.
CACHE_WORDS, CHUNK = 200_000, 1 << 18
TEMPERATURES = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0]


def _hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 0..order the hash of the n characters that end at each place."""
    out, power = [np.zeros(len(codes), np.uint64)], np.uint64(1)
    with np.errstate(over="ignore"):
        for n in range(order):
            power = power * _PRIME
            shifted = np.concatenate([np.zeros(min(n, len(codes)), np.uint64), codes[: max(len(codes) - n, 0)]])
            out.append(out[-1] + (shifted + np.uint64(1)) * power)
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def letter_runs(tokens: list[bytes], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of letters (and marks on them) in lower-cased tokens: their code points one
    after the other, each with ``pad`` beginnings before and an end after it; how long
    each is with these; which token it comes from."""
    codes = _codes(b"\n".join(tokens).decode("utf-8", "replace").lower())
    known, at = np.unique(codes, return_inverse=True)
    kind = [unicodedata.category(chr(c))[0] for c in known.tolist()]
    letter = np.array([k == "L" for k in kind], bool)[at]
    inside = letter | np.array([k == "M" for k in kind], bool)[at]
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    letters = np.append(np.flatnonzero(letter), len(codes))
    start = letters[np.searchsorted(letters, start)]  # a mark on nothing begins no run
    start, stop = start[start < stop], stop[start < stop]
    owner = np.cumsum(codes == 10)[start]
    n, total = stop - start, stop - start + pad + 1
    ends = np.cumsum(total)
    out = np.full(total.sum(), ord(BEGIN), np.uint64)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(ends - total + pad, n) + place] = codes[np.repeat(start, n) + place]
    out[ends - 1] = ord(END)
    return out, total, owner


def _row_hashes(codes: np.ndarray) -> np.ndarray:
    """For each row of characters the hash that ``_hashes`` has for them."""
    out, power = np.zeros(len(codes), np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for column in codes.T[::-1]:
            power = power * _PRIME
            out += (column.astype(np.uint64) + np.uint64(1)) * power
    return out


def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is there, and the value (or row of values) at its place."""
    hashes, values = table
    if not len(hashes):
        return np.zeros(len(keys), bool), np.zeros((len(keys), *values.shape[1:]))
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return hashes[at] == keys, values[at]


@dataclass
class CharacterModel:
    """Log probabilities of n-grams and log back-off weights of histories, by order."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    backoff: list[tuple[np.ndarray, np.ndarray]]
    unseen: float
    #: The characters of the n-grams, a row each, by order.
    names: list[np.ndarray]

    @classmethod
    def fit(cls, counts: dict[str, int], order: int) -> CharacterModel:
        """``counts``: n-grams of the highest order, words padded in front."""
        return cls.fit_rows(_codes("".join(counts)).reshape(-1, order), np.array(list(counts.values()), np.float64))

    @classmethod
    def fit_rows(cls, codes: np.ndarray, counts: np.ndarray) -> CharacterModel:
        """``codes``: the characters of each n-gram of the highest order, none twice."""
        order = codes.shape[1]
        levels = {order: (codes.astype(np.uint32), counts.astype(np.float64))}
        for n in range(order - 1, 0, -1):
            names, count = levels[n + 1]
            names = names[:, 1:]
            _, first, at = np.unique(_row_hashes(names), return_index=True, return_inverse=True)
            # What follows the beginning of a word has one predecessor only: its count stands in.
            levels[n] = names[first], np.bincount(at, np.where(names[:, 0] == ord(BEGIN), count, 1.0))
        alphabet = len(levels[1][0]) + 1
        empty = np.zeros(0, np.uint64), np.zeros(0)
        grams, backoff = [empty], [empty]
        for n in range(1, order + 1):
            names, count = levels[n]
            histories, at = np.unique(_row_hashes(names[:, :-1]), return_inverse=True)
            total, kinds = np.bincount(at, count), np.bincount(at)
            once, twice = int((count == 1).sum()), int((count == 2).sum())
            discount = once / (once + 2 * twice) if once and twice else 0.5
            weight = discount * kinds / total
            below = np.exp(_find(grams[-1], _row_hashes(names[:, 1:]))[1]) if n > 1 else 1 / alphabet
            here = np.log((count - discount) / total[at] + weight[at] * below)
            hashed = _row_hashes(names)
            order_by = np.argsort(hashed)
            grams.append((hashed[order_by], here[order_by]))
            backoff.append((histories, np.log(weight)))
        return cls(grams, backoff, -float(np.log(alphabet)), [np.zeros((0, 0), np.uint32), *(levels[n][0] for n in range(1, order + 1))])

    def log_probabilities(self, hashes: list[np.ndarray], histories: list[np.ndarray]) -> np.ndarray:
        """Of each character, given hashes of the n characters up to it and before it, for
        n from 0 to the order to begin with."""
        out, open_ = np.zeros(len(hashes[0])), np.arange(len(hashes[0]))
        for n in range(len(hashes) - 1, 0, -1):
            seen, value = _find(self.grams[n], hashes[n][open_])
            out[open_[seen]] += value[seen]
            open_ = open_[~seen]
            known, value = _find(self.backoff[n], histories[n - 1][open_])
            out[open_[known]] += value[known]
        out[open_] += self.unseen
        return out


def _together(models: list[CharacterModel], n: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of any language by hash, with the log probability in every language."""
    names = np.concatenate([m.names[n] for m in models])
    keys, first = np.unique(_row_hashes(names), return_index=True)
    names = names[first]
    hashes = [_row_hashes(names[:, n - k :]) for k in range(n + 1)]
    before = [_row_hashes(names[:, n - 1 - k : n - 1]) for k in range(n)]
    return keys, np.stack([m.log_probabilities(hashes, before) for m in models], axis=1)


def _weights_together(models: list[CharacterModel], n: int) -> tuple[np.ndarray, np.ndarray]:
    """All histories of n-grams by hash, with the log back-off weight in every language
    (none, so zero, where a language doesn't know the history)."""
    keys = np.unique(np.concatenate([m.backoff[n][0] for m in models]))
    found = [_find(m.backoff[n], keys) for m in models]
    return keys, np.stack([np.where(seen, value, 0.0) for seen, value in found], axis=1)


@dataclass
class LanguageModels:
    """The models of all languages in common sorted hash arrays, so that one search
    serves all of them: place 0 is not used, place n has what concerns n-grams."""

    order: int
    languages: list[str] = field(default_factory=list)
    models: InitVar[list[CharacterModel]] = ()
    #: The highest cross-entropy accepted in an endless text, by language; the sharpness of the score.
    highest: list[float] = field(default_factory=list)
    temperature: float = 16.0
    #: A text of n characters may lie ``margin / sqrt(n)`` above ``highest``.
    margin: float = MARGIN

    def __post_init__(self, models):
        if models:
            orders = range(1, self.order + 1)
            self.grams = [None, *(_together(models, n) for n in orders)]
            self.backoff = [None, *(_weights_together(models, n) for n in orders)]
            self.unseen = np.array([m.unseen for m in models])

    def log_probabilities(self, hashes: list[np.ndarray], histories: list[np.ndarray]) -> np.ndarray:
        """Of each character in every language."""
        out, open_ = np.zeros((len(hashes[0]), len(self.languages))), np.arange(len(hashes[0]))
        for n in range(self.order, 0, -1) if self.languages else ():
            seen, value = _find(self.grams[n], hashes[n][open_])
            out[open_[seen]] += value[seen]
            open_ = open_[~seen]
            known, value = _find(self.backoff[n], histories[n - 1][open_])
            out[open_[known]] += value[known]
        if self.languages:
            out[open_] += self.unseen
        return out

    def word_scores(self, tokens: list[bytes]) -> np.ndarray:
        """For each token the summed log probability by language, then its characters, ends included."""
        out = np.zeros((len(tokens), len(self.languages) + 1))
        codes, lengths, owner = letter_runs(tokens, self.order - 1)
        if not len(lengths):
            return out
        hashes = _hashes(codes, self.order)
        histories = [np.concatenate([h[:1], h[:-1]]) for h in hashes]
        start = np.cumsum(lengths) - lengths
        event = np.arange(len(codes)) - np.repeat(start, lengths) >= self.order - 1
        hashes, histories = [h[event] for h in hashes], [h[event] for h in histories]
        first = start - np.arange(len(start)) * (self.order - 1)
        scores = self.log_probabilities(hashes, histories)
        scores = np.concatenate([scores, np.ones((len(scores), 1))], axis=1)
        np.add.at(out, owner, np.add.reduceat(scores, first))
        return out

    def entropies(self, batches: Iterator[Sequence[bytes]]) -> Iterator[np.ndarray]:
        """For each batch of texts their cross-entropy by language, then their characters."""
        scores = [np.zeros((0, len(self.languages) + 1))]

        def learn(new: list[bytes]) -> None:
            scores[0] = np.concatenate([scores[0], self.word_scores(new)])

        def forget() -> None:
            scores[0] = scores[0][:0]

        index = WordIndex(learn, forget, CACHE_WORDS, CHUNK)
        for texts in batches:
            out = np.zeros((len(texts), len(self.languages) + 1))
            for first, chunk in chunks(texts, CHUNK):
                row, ends = index.rows(chunk)
                found = scores[0][row]
                total = np.concatenate([np.zeros((1, found.shape[1])), np.cumsum(found, axis=0)])
                out[first : first + len(chunk)] = total[ends] - total[np.concatenate([[0], ends[:-1]])]
            n = out[:, -1:]
            out[:, :-1] = -out[:, :-1] / np.maximum(n, 1)
            yield out

    def decide(self, entropies: np.ndarray) -> dict[str, np.ndarray]:
        per, n = entropies[:, :-1], entropies[:, -1]
        if not self.languages:
            return {
                "lang_pred": np.full(len(n), UNDETERMINED, object),
                "score": np.zeros(len(n)),
                "entropy": np.full(len(n), np.nan),
                "accepted": np.zeros(len(n), bool),
            }
        best = per.argmin(axis=1)
        low = per[np.arange(len(n)), best]
        score = 1 / np.exp(-self.temperature * (per - low[:, None])).sum(axis=1)
        letters = n > 0
        limit = np.array(self.highest)[best] + self.margin / np.sqrt(np.maximum(n, 1))
        return {
            "lang_pred": np.where(letters, np.array(self.languages, dtype=object)[best], UNDETERMINED),
            "score": np.where(letters, score, 0.0),
            "entropy": np.where(letters, low, np.nan),
            "accepted": letters & (low <= limit),
        }


def _entropy_udf(models: LanguageModels):
    @F.arrow_udf("array<double>")
    def entropies(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for out in models.entropies(map(Texts, texts)):
            ends = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))
        hand_back()

    return entropies


def limits(texts: list[np.ndarray], quantile: float, slack: float, margin: float) -> list[float]:
    """For each language the highest cross-entropy accepted, ``margin`` aside, from the
    cross-entropies and characters of its texts kept back: the ``quantile`` of what they need,
    plus ``slack`` over the root of their number. A language without any gets the limit of
    all languages together."""

    def limit(of: np.ndarray) -> float:
        need = of[:, 0] - margin / np.sqrt(of[:, 1])
        return float(np.quantile(need, quantile, method="higher") + slack / np.sqrt(len(of)))

    every = np.concatenate([np.zeros((0, 2)), *texts])
    return [limit(t if len(t) else every) if len(every) else float("inf") for t in texts]


#: Characters of a token whose n-grams are taken at a time.
STRETCH = 1000


def _grams(padded: Column, order: int) -> Column:
    """All runs of ``order`` characters of a text that has as many. A substring is counted off from the
    beginning of a text, so they are taken from stretches of it: else a long text would take its square."""

    def of(stretch: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(stretch) - (order - 1)), lambda i: F.substring(stretch, i, F.lit(order)))

    firsts = F.sequence(F.lit(0), F.floor((F.length(padded) - order) / STRETCH).cast("int"))
    stretches = F.transform(firsts, lambda k: F.substring(padded, k * STRETCH + 1, F.lit(STRETCH + order - 1)))
    return F.flatten(F.transform(stretches, of))


def train(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    order: int = ORDER,
    sample_docs: int = SAMPLE_DOCS,
    quantile: float = 0.999,
    slack: float = SLACK,
    margin: float = MARGIN,
) -> LanguageModels:
    """Models of the languages in ``docs``; rows without text or language are passed over.

    Learned from a bounded sample: about ``sample_docs`` distinct texts of each language, of
    which a fifth is kept back to calibrate the sharpness of the score and the highest
    accepted cross-entropy (``limits``). The driver gets all n-grams of the sample with
    their counts, as columns of Arrow, and fits the models in arrays; of a text kept back it
    gets the cross-entropy and the length.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    key = F.xxhash64("text")
    distinct = rows.select("lang", key.alias("key")).distinct()
    sizes = {r.lang: r.n for r in distinct.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModels(order)
    share: Column = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, min(1.0, sample_docs / n)).otherwise(share)
    # Of copies one, so that the sample has the size it is due and no text weighs more than another.
    rows = rows.where(share_below(key, share)).withColumn("key", key).dropDuplicates(["lang", "key"])
    kept_back = F.pmod(F.xxhash64(F.col("key"), F.lit("calibrate")), F.lit(5)) == 0
    tokens = (
        rows.where(~kept_back)
        .select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), F.lit(0))).alias("token"))
        .groupBy("lang", "token")
        .agg(F.count("*").alias("n"))
    )
    padded = F.concat(F.lit(BEGIN * (order - 1)), F.col("token"), F.lit(END))
    grams = (
        tokens.select("lang", "n", F.explode(_grams(padded, order)).alias("gram"))
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    found = grams.toArrow()
    languages = sorted(pc.unique(found["lang"]).to_pylist())
    fitted = []
    for name in languages:
        own = found.filter(pc.equal(found["lang"], name)).combine_chunks()
        names = pc.binary_join(pa.ListArray.from_arrays([0, own.num_rows], own["gram"].chunk(0)), "")[0].as_py()
        fitted.append(CharacterModel.fit_rows(_codes(names).reshape(-1, order), own["n"].to_numpy()))
    models = LanguageModels(order, languages, fitted, [float("inf")] * len(languages))
    if not languages:
        return models
    scored = rows.where(kept_back & F.col("lang").isin(languages)).select("lang", _entropy_udf(models)(utf8("text")).alias("e"))
    scored = scored.where(F.element_at("e", -1) > 0)
    own = F.element_at("e", F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int"))
    per = F.slice("e", 1, len(languages))
    low = F.array_min(per)

    def loss(t: float) -> Column:
        """The negative logarithm of the score that the right language gets."""
        return F.sum(t * (own - low) + F.log(F.aggregate(per, F.lit(0.0), lambda a, x: a + F.exp(-t * (x - low)))))

    fits = [loss(t).alias(f"loss{k}") for k, t in enumerate(TEMPERATURES)]
    texts = F.collect_list(F.struct(own.alias("own"), F.element_at("e", -1).alias("n"))).alias("texts")
    found = scored.groupBy("lang").agg(texts, *fits).collect()
    own_texts = {r.lang: np.array(r.texts, np.float64) for r in found}
    models.highest = limits([own_texts.get(x, np.zeros((0, 2))) for x in languages], quantile, slack, margin)
    models.margin = margin
    if not found:  # no better than guessing letters
        models.highest = [-m.unseen for m in fitted]
    if found:
        losses = [sum(r[f"loss{k}"] or 0.0 for r in found) for k in range(len(TEMPERATURES))]
        models.temperature = TEMPERATURES[int(np.argmin(losses))]
    return models


def identify_udf(models: LanguageModels):
    """A column function from the bytes of a text to ``lang_pred, score, entropy, accepted``."""
    @F.arrow_udf("lang_pred string, score double, entropy double, accepted boolean")
    def identify(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for out in models.entropies(map(Texts, texts)):
            found = models.decide(out)
            yield pa.StructArray.from_arrays([pa.array(v) for v in found.values()], list(found))
        hand_back()

    return identify


def identify(docs: DataFrame, models: LanguageModels, text: str = "text", into: str = "language") -> DataFrame:
    """Adds the struct ``into``: ``lang_pred`` (the language with the lowest cross-entropy per
    character; `und` for a NULL text or one without letters), ``score`` (0 to 1),
    ``entropy`` and ``accepted``. All other columns pass, one named ``into`` is replaced."""
    return docs.withColumn(into, identify_udf(models)(utf8(text)))


def in_a_language(docs: DataFrame, models: LanguageModels, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is accepted in the language predicted, as they are."""
    found = identify(docs, models, text, "__language").where("__language.accepted")
    return found.drop("__language")
