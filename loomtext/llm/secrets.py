"""Operator 2: secret scans by fixed patterns and character Markov models.

Three pattern kinds (assign, access, hex) find secrets by shape. The method adds the kind `markov`: long token runs that
two character Markov models, one of random strings and one of ordinary identifiers, tell apart by their
log-likelihood ratio per character. The models are trained from labelled samples. Random strings: those that the patterns label in
all documents, each once, and strings drawn from a seeded generator over the usual key alphabets. Identifiers: names made of the
words of all documents, each weighing as often as its word occurs, joined in the usual ways. Strings and words are counted, and
their trigrams summed, by distributed aggregates; the trigram table is bounded by the alphabet. The threshold is calibrated on
samples held out of the counts. Added spans never overlap a pattern's span.

Offsets are code points, end exclusive. Defined cases: a null or empty text has no spans; a table without words or secrets gives
models of the generated samples alone; repeated rows are scanned each; an empty table gives an empty result. Every
text is scanned whole. Ids are passed on untouched, null ones too. Other columns may have any names: a scan ignores them and
redaction returns them as they are.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import discard, materialise, materialise_small, table
from .textcore import released

KINDS = ("assign", "access", "hex", "markov")
#: Generated samples of each class, beside the identifiers made of the corpus.
SAMPLES = 20_000
MIN_RUN = 20
#: Share of held-out identifiers that may pass as random.
FALSE_ALARMS = 0.0005
REPLACEMENT = "[SECRET]"

_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_RUN)
_WORD = re.compile(r"[A-Za-z]{2,}")
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_CODE = np.full(128, 0, dtype=np.int64)
_CODE[[ord(c) for c in _ALPHABET]] = np.arange(1, len(_ALPHABET) + 1)
_STATES = len(_ALPHABET) + 1

#: Words that names in programs and addresses are made of, beside those of the corpus.
COMMON_WORDS = (
    "access account action add address admin after agent alert all amount api app archive array async auth author backup base batch before begin bin block body bool buffer build button byte cache call cancel "
    "case cell chain change channel char check child class clean clear client clock close cluster code color column command comment commit common config connect content context control convert copy count "
    "create current cursor custom data date debug default delete depth detail device dict diff digest direct disk display document domain double down driver edge edit element email enable encode end engine "
    "entry error event example exception export extra factory field file filter find first flag float folder font format frame from function gate generic get global graph group handle hash header height hidden "
    "history hook host html http icon identifier image import index info init inner input insert instance int item iterator job join json key label language last layer layout length level library limit line link "
    "list load local lock log loop main manager map mask match matrix max member memory menu merge message meta method metric min mode model module month mount move multi name native net network next node "
    "none normal note null number object offset old open operator option order origin other output owner package page pair panel parameter parent parse part partition path pattern payload pending pixel plan player "
    "plugin point policy pool port position post prefix previous price print private process product profile program project property protocol provider proxy public query queue quick random range rate read record "
    "reference region register release remote remove render repeat replace report request reset resource response result return role root route row rule run sample save scale schema scope score screen script search "
    "section select sequence server service session set setting shape share shift shop short side signal simple single size skip slot small socket sort source space split stack stage start state static status step "
    "stop storage store stream string style submit sum support switch symbol sync system table tag target task team template temp test text theme thread time title toggle tool top total trace track transform tree "
    "trigger type unique unit update upload url usage user util valid value vector version video view wait watch web week weight widget width window word worker wrapper write year zone"
).split()

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    for run in _RUN.finditer(text):  # the other kinds lie within a run, whole
        body, at = run[0], run.start()
        found += [(at + m.start(), at + m.end(), "access") for m in _ACCESS.finditer(body) if m.end() - m.start() >= 20]
        found += [(at + m.start(), at + m.end(), "hex") for m in _HEX.finditer(body)]
    return found


def _codes(token: str) -> np.ndarray:
    return _CODE[np.frombuffer(token.encode("ascii"), dtype=np.uint8)]


def _trigrams(tokens: Sequence[str], weights: Sequence[int]) -> np.ndarray:
    """Counts of all character triples of weighted tokens."""
    triples, lengths = _triples(tokens)
    return np.bincount(triples, weights=np.repeat(np.asarray(weights, dtype=float), lengths), minlength=_STATES**3)


def _triples(tokens: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of every character's triple (two characters before it, or marks of the beginning) of all tokens, and the tokens' lengths."""
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    c = _codes("\0\0" + "\0\0".join(tokens))
    return ((c[:-2] * _STATES + c[1:-1]) * _STATES + c[2:])[c[2:] > 0], lengths


class MarkovPair:
    """Order-2 character models of random strings and identifiers, interpolated with order 1, as one table of log-ratios."""

    def __init__(self, ratio: np.ndarray, threshold: float):
        self.ratio, self.threshold = ratio, threshold

    @classmethod
    def train(cls, random_strings: Sequence[str], identifiers: Sequence[str], false_alarms: float = FALSE_ALARMS) -> MarkovPair:
        fit = [x for i, x in enumerate(random_strings) if i % 5], [x for i, x in enumerate(identifiers) if i % 5]
        ratio = cls._log_model(fit[0]) - cls._log_model(fit[1])
        pair = cls(ratio, 0.0)
        held = sorted(pair.score(x) for i, x in enumerate(identifiers) if not i % 5)
        pair.threshold = max(0.0, held[min(len(held) - 1, int(len(held) * (1 - false_alarms)))]) if held else 0.0
        return pair

    @staticmethod
    def _log_model(samples: Sequence[str]) -> np.ndarray:
        return MarkovPair._log_of(_trigrams(samples, [1] * len(samples)))

    @staticmethod
    def _log_of(counts: np.ndarray) -> np.ndarray:
        triples = counts.reshape(_STATES, _STATES, _STATES)
        pairs = triples.sum(axis=0)
        singles = pairs.sum(axis=0) + 1.0
        base = singles / singles.sum()
        kinds = (pairs > 0).sum(axis=1, keepdims=True) + 1.0
        first = (pairs + kinds * base) / (pairs.sum(axis=1, keepdims=True) + kinds)
        kinds = (triples > 0).sum(axis=2, keepdims=True) + 1.0
        second = (triples + kinds * first[None]) / (triples.sum(axis=2, keepdims=True) + kinds)
        return np.log(second)

    def score(self, token: str) -> float:
        c = np.concatenate(([0, 0], _codes(token)))
        return float(self.ratio[c[:-2], c[1:-1], c[2:]].mean())


def _scores(models: MarkovPair, names: Sequence[str]) -> np.ndarray:
    """models.score of every name, to three decimals."""
    if not names:
        return np.zeros(0)
    triples, lengths = _triples(names)
    return np.round(np.add.reduceat(models.ratio.reshape(-1)[triples], np.cumsum(lengths) - lengths) / lengths, 3)


def random_samples(n: int = SAMPLES, seed: int = 7) -> list[str]:
    draw = random.Random(seed)
    upper, lower, digits = _ALPHABET[:26], _ALPHABET[26:52], _ALPHABET[52:62]
    alphabets = (digits + "abcdef", digits + "ABCDEF", upper + lower + digits, upper + lower + digits + "+/", upper + lower + digits + "_-", upper + digits, lower + digits)
    return ["".join(draw.choices(draw.choice(alphabets), k=draw.randint(MIN_RUN, 64))) for _ in range(n)]


_STYLES = ("", "_", "-", ".", "/", "Camel", "UPPER")


def _named(draw: random.Random, style: str, parts: Sequence[str]) -> str:
    if style == "Camel":
        name = "".join(p.capitalize() for p in parts)
    elif style == "UPPER":
        name = draw.choice(("", "_")).join(p.upper() for p in parts)
    else:
        name = style.join(parts)
    if draw.random() < 0.2:
        name += draw.choice(("", "_", "-", ".")) + str(draw.randint(0, 2030))
    return name


def identifier_samples(words: Sequence[str], n: int = SAMPLES, seed: int = 11) -> list[str]:
    """Names of at least MIN_RUN characters made of words: joined plainly, with _, -, ., / or capitals, with or without a number."""
    draw = random.Random(seed)
    words = list(words)
    out = []
    for _ in range(n):
        style, parts = draw.choice(_STYLES), []
        while sum(map(len, parts)) < MIN_RUN + draw.randint(0, 12):
            parts.append(draw.choice(words if words and draw.random() < 0.5 else COMMON_WORDS))
        out.append(_named(draw, style, parts))
    return out


def word_identifiers(word: str) -> list[str]:
    """Names in two styles of a word, about half of their parts, and common words; the same for a word on any machine."""
    draw, out = random.Random(zlib.crc32(word.encode())), []
    for style in draw.sample(_STYLES, 2):
        parts = [word]
        while sum(map(len, parts)) < MIN_RUN + draw.randint(0, 12):
            parts.append(word if draw.random() < 0.5 else draw.choice(COMMON_WORDS))
        draw.shuffle(parts)
        out.append(_named(draw, style, parts))
    return out


def _held_out(name: str) -> bool:
    return zlib.crc32(name.encode()) % 5 == 0


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """(secret, sample, n): the words of all documents outside of secrets with their occurrences, and the strings of MIN_RUN
    characters or more that the patterns label as secrets."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            words: Counter = Counter()
            labelled: Counter = Counter()
            for body in batch.column("text").to_pylist():
                labelled.update(secret_strings(body))
                words.update(_WORD.findall(without(body, base_spans(body))))
            yield _packed(["secret", "sample", "n"], [*[(False, w, n) for w, n in words.items()], *[(True, x, n) for x, n in labelled.items()]], [pa.bool_(), pa.string(), pa.int64()])

    texts = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    return texts.mapInArrow(released(run), "secret boolean, sample string, n long").groupBy("secret", "sample").agg(F.sum("n").alias("n"))


def _packed(names: Sequence[str], rows: Sequence[tuple], types: Sequence[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)], list(names))


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the occurrences of every word in all documents."""
    return labelled_samples(docs, text).where("NOT secret").select(F.col("sample").alias("word"), "n")


def without(text: str, spans: Sequence[Span]) -> str:
    """The text with a blank in place of each span."""
    parts, done = [], 0
    for begin, end, _ in sorted(spans):
        parts.append(text[done : max(begin, done)])
        done = max(done, end)
    return " ".join([*parts, text[done:]]) if spans else text


def secret_strings(text: str) -> list[str]:
    """The strings of at least MIN_RUN characters that the patterns label, without the name before them."""
    if not (":" in text or "=" in text or max(map(len, text.split()), default=0) >= MIN_RUN):
        return []
    found = [(m[2]) for m in _ASSIGN.finditer(text)] if ":" in text or "=" in text else []
    for run in _RUN.finditer(text):
        found += [m[0] for m in _ACCESS.finditer(run[0])] + [m[0] for m in _HEX.finditer(run[0])]
    return [x for x in found if len(x) >= MIN_RUN]


def train_models(docs: DataFrame, text: str = "text", samples: int = SAMPLES) -> MarkovPair:
    """The models from the generated samples, and the labelled strings and the words of all documents."""
    known = materialise_small(labelled_samples(docs, text), "samples")
    words = known.where("NOT secret").select("sample", "n")

    def triples(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {False: np.zeros(_STATES**3), True: np.zeros(_STATES**3)}
        for batch in found:
            names: dict[bool, list] = {False: [], True: []}
            for secret, sample, n in zip(*[batch.column(c).to_pylist() for c in ("secret", "sample", "n")], strict=True):
                if secret:
                    names[True].append((sample, 1))  # a secret in many copies is one sample
                else:
                    names[False] += [(x, n) for x in word_identifiers(sample) if not _held_out(x)]
            for side, listed in names.items():
                total[side] += _trigrams([x for x, _ in listed], [n for _, n in listed])
        for side, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), side)), pa.array(at), pa.array(counts[at].astype(np.int64))], ["secret", "triple", "n"])

    made, drawn = identifier_samples((), samples), random_samples(samples)
    counts = {
        False: _trigrams([x for x in made if not _held_out(x)], [1] * sum(not _held_out(x) for x in made)),
        True: _trigrams([x for i, x in enumerate(drawn) if i % 5], [1] * sum(i % 5 > 0 for i in range(len(drawn)))),
    }
    # at most two tables of the alphabet's triples
    for side, triple, n in known.mapInArrow(released(triples), "secret boolean, triple long, n long").groupBy("secret", "triple").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False):
        counts[side][triple] += n
    models = MarkovPair(MarkovPair._log_of(counts[True]) - MarkovPair._log_of(counts[False]), 0.0)

    def scores(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            seen: Counter = Counter()
            names = [(x, n) for word, n in zip(batch.column("sample").to_pylist(), batch.column("n").to_pylist(), strict=True) for x in word_identifiers(word) if _held_out(x)]
            for value, (_, n) in zip(_scores(models, [x for x, _ in names]).tolist(), names, strict=True):
                seen[value] += n
            yield _packed(["score", "n"], list(seen.items()), [pa.float64(), pa.int64()])

    # scores of three decimals, so the histogram is bounded
    bins = Counter({r[0]: r[1] for r in words.mapInArrow(released(scores), "score double, n long").groupBy("score").agg(F.sum("n")).collect()})
    bins.update(_scores(models, [x for x in made if _held_out(x)]).tolist())
    discard(known)
    left = FALSE_ALARMS * sum(bins.values())
    for value in sorted(bins, reverse=True):
        left -= bins[value]
        if left < 0:
            models.threshold = max(0.0, value)
            break
    return models


def all_spans(text: str | None, models: MarkovPair) -> tuple[list[Span], list[Span]]:
    """(base, all) spans of a text, by start, then kind as listed."""
    if not text or not (":" in text or "=" in text or max(map(len, text.split()), default=0) >= MIN_RUN):
        return [], []
    key = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base = sorted(base_spans(text), key=key)
    added = []
    starts, reach = [s for s, _, _ in base], list(accumulate((e for _, e, _ in base), max))
    for run in _RUN.finditer(text):
        begin, end = run.span()
        before = bisect_left(starts, end)  # base spans that start before the run's end
        if not (before and reach[before - 1] > begin) and models.score(run[0]) > models.threshold:
            added.append((begin, end, "markov"))
    return base, sorted(base + added, key=key) if added else base


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame, models: MarkovPair | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, the counts of the base kinds, base_sha256, spans and n_markov."""
    models = models or train_models(docs, text)
    names = ["n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans"]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rows = []
            for body in batch.column("text").to_pylist():
                base, spans = all_spans(body, models)
                kinds = [s[2] for s in spans]
                rows.append((*[kinds.count(k) for k in KINDS], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            packed = _packed(names, rows, [pa.int64()] * 4 + [pa.string()] * 2)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *packed.columns], ["doc_id", *names])

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([slim.schema["doc_id"], *[StructField(n, LongType() if n.startswith("n_") else StringType()) for n in names]])
    return materialise_small(slim.mapInArrow(released(run), schema), "secrets")


def redact(text: str | None, models: MarkovPair) -> str | None:
    """The text with every span, overlapping ones as one, replaced."""
    spans = all_spans(text, models)[1]
    if not spans:
        return text
    parts, done = [], 0
    for begin, end, _ in spans:
        if begin >= done:
            parts += [text[done:begin], REPLACEMENT]
        done = max(done, end)
    return "".join(parts) + text[done:]


def redacted(text: Column, models: MarkovPair) -> Column:
    @F.pandas_udf("string")
    def clean(bodies: pd.Series) -> pd.Series:
        return pd.Series([redact(b, models) for b in bodies], dtype=object)

    return clean(text)


def redact_secrets(docs: DataFrame, models: MarkovPair | None = None, text: str = "text", length: str | None = None) -> DataFrame:
    """docs with the secrets in its text column replaced; all rows and other columns stay.

    A column named by `length` gets the new number of characters where the text changed.
    """
    models = models or train_models(docs, text)
    new = {text: redacted(F.col(text), models)}
    if length is not None:
        changed = F.when(new[text] != F.col(text), F.length(new[text]).cast(docs.schema[length].dataType))
        new[length] = F.coalesce(changed, F.col(length))
    return materialise_small(docs.withColumns(new), "redacted")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return scan_secrets(table(spark, sf_dir, "documents"))
