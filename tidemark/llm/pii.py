"""Personal data: labelers vote on candidate spans, EM weighs them, a classifier decides.

1. One pass over the texts finds the base spans, which always stay, and further candidates:
   shapes that the base patterns run past (a number that touches the next one) or do not
   know (addresses spelt out, numbers without a plus). Regular expressions, a gazetteer, the context and the shape vote or
   abstain on each, base or not.
2. Votes are counted by pattern; kinds times 3^labelers bounds their number. Expectation-
   maximisation estimates for each labeler how often it errs, and each pattern's posterior.
3. A logistic span classifier over hashed shape and context features learns from those
   posteriors, on a bounded sample, and scores all candidates that are not base spans.

The texts are read once; what is stored between the steps has one row per document.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Tables, texts

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "gazetteer", "context", "border", "digits")

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What the base patterns miss. Each shape is bounded, so it never runs into its neighbour.
_MORE = {
    "email": [
        re.compile(
            r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}"
            r"(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[A-Za-z0-9-]{2,63}){1,4}",
            re.I,
        ),
    ],
    "ip": [re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")],
    "card": [
        re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
        re.compile(r"(?<![0-9])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
        re.compile(r"(?<![0-9])3[0-9]{3}([ -])[0-9]{6}\1[0-9]{5}(?![0-9])"),
    ],
    "phone": [
        re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"),
        re.compile(r"(?<![0-9+(])\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
        re.compile(r"(?<![0-9.+-])[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}(?![0-9.-])"),
    ],
}

# Common ends of mail domains, and words near a kind of personal data.
_DOMAINS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "eu", "nl", "ch", "at"}
_NEAR = {
    "email": re.compile(r"e-?mail|contact|write|correo|courriel|kontakt|reach", re.I),
    "ip": re.compile(r"\bip\b|server|host|address|adresse|dirección|ping|login", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|karte|carte|tarjeta|payment|pay\b", re.I),
    "phone": re.compile(r"phone|tel|call|fax|mobile|cell|whatsapp|llam|appel|anruf|handy|móvil", re.I),
}
_AGAINST = re.compile(r"version|isbn|issn|order|invoice|ticket|serial|doi|release|build|token|sha|hash|key", re.I)
_AROUND = 32


@dataclass(frozen=True)
class PersonalData:
    """``sample`` bounds the candidates the classifier learns from, and so what reaches
    the driver; ``features`` is the size of its table."""

    threshold: float = 0.5
    sample: int = 20_000
    features: int = 1 << 12
    rounds: int = 30
    epochs: int = 200


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _part(text: str) -> bool:
    """Whether a part of an address is at most 255."""
    short = text.lstrip("0")
    return len(short) < 3 or (len(short) == 3 and short <= "255")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans that always stay, by kind."""
    out: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if "@" in text:
        # Only what surrounds an @ can match, and a match has no other @.
        done = 0
        at = text.find("@")
        while at >= 0:
            start = at
            while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
                start -= 1
            m = _EMAIL.match(text, start) if start < at else None
            if m:
                out["email"].append(m.span())
                done = m.end()
            else:
                done = at + 1
            at = text.find("@", done)
    for m in _IP.finditer(text):
        if all(map(_part, m.group().split("."))):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out["phone"].append(m.span())
    return out


def candidates(text: str, base: dict[str, list[tuple[int, int]]]) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, is base) of base spans, and of others that touch none of them."""
    taken = _apart(span for spans in base.values() for span in spans)
    for kind in KINDS:
        for start, end in base[kind]:
            yield kind, start, end, True
    for kind in KINDS:
        for pattern in _MORE[kind]:
            starts, found = [a for a, _ in taken], []
            for m in pattern.finditer(text):
                start, end = m.span()
                # The last taken span that begins before this one ends.
                k = bisect_left(starts, end) - 1
                if k >= 0 and taken[k][1] > start:
                    continue
                if kind == "card" and not luhn(_digits(m.group())):
                    continue
                found.append((start, end))
                yield kind, start, end, False
            taken = _apart((*taken, *found))


def _apart(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def votes(kind: str, text: str, start: int, end: int) -> list[int]:
    """1 personal, 0 not, -1 abstains, in the order of ``LABELERS``."""
    span, before = text[start:end], text[max(0, start - _AROUND) : start]
    digits = _digits(span)
    around = text[start - 1 : start] + text[end : end + 1]
    if kind == "email":
        pattern = 1 if _EMAIL.fullmatch(span) else -1
        gazetteer = 1 if re.split(r"[^A-Za-z0-9-]+", span.lower())[-1] in _DOMAINS else -1
        plausible = 1 if re.search("[A-Za-z]", span) else 0
    elif kind == "ip":
        pattern = 1 if _IP.fullmatch(span) or span.count(":") == 7 else 0
        gazetteer = 0 if span.split(".")[0] in ("0", "00", "000") else 1
        plausible = 1 if max(map(len, re.split("[.:]", span))) <= 4 else 0
    elif kind == "card":
        pattern = 1 if 16 <= len(digits) <= 19 else -1
        gazetteer = 1 if digits[0] in "3456" else -1
        plausible = 1 if len(set(digits)) > 3 else 0
    else:
        pattern = 1 if _PHONE.fullmatch(span) else -1
        gazetteer = 1 if span[0] in "+(" else -1
        plausible = 1 if 10 <= len(digits) <= 13 and len(set(digits)) > 2 else 0 if len(set(digits)) <= 2 else -1
    context = 1 if _NEAR[kind].search(before) else 0 if _AGAINST.search(before) else -1
    border = 0 if any(c.isalnum() or c in "_=/" for c in around) else 1
    return [pattern, gazetteer, context, border, plausible]


def span_features(kind: str, text: str, start: int, end: int, size: int) -> list[int]:
    """Hashed shape and context features of a span."""
    shape = re.sub(r"[0-9]", "9", re.sub(r"[A-Za-z]+", "a", text[start:end]))
    before = text[max(0, start - _AROUND) : start].split()[-2:]
    after = text[end : end + _AROUND].split()[:1]
    names = [f"kind {kind}", f"{kind} shape {shape[:40]}", f"{kind} length {min(end - start, 24)}"]
    names += [f"{kind} before {w.lower()}" for w in before] + [f"{kind} after {w.lower()}" for w in after]
    names += [f"{kind} left {text[start - 1 : start]!r}", f"{kind} right {text[end : end + 1]!r}"]
    names += [f"{kind} vote {k} {v}" for k, v in enumerate(votes(kind, text, start, end))]
    return [xxhash.xxh32_intdigest(n) % size for n in names]


FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,"
    "spans array<struct<kind:int,start:int,end:int,base:boolean,votes:int,features:array<int>>>"
)


def _code(found: list[int]) -> int:
    """Votes as one number, base 3."""
    code = 0
    for v in found:
        code = 3 * code + v + 1
    return code


def find(docs: DataFrame, p: PersonalData) -> DataFrame:
    """One row of ``FOUND`` for each row of ``docs``."""

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = (data or b"").decode("utf-8", "replace")
                base = base_spans(text)
                named = ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in base[kind])
                spans = [
                    {
                        "kind": KINDS.index(kind),
                        "start": a,
                        "end": b,
                        "base": is_base,
                        "votes": _code(votes(kind, text, a, b)),
                        "features": span_features(kind, text, a, b, p.features),
                    }
                    for kind, a, b, is_base in candidates(text, base)
                ]
                digest = hashlib.sha256(named.encode()).hexdigest()
                rows.append((doc_id, *[len(base[kind]) for kind in KINDS], digest, spans))
            columns = list(zip(*rows)) if rows else [()] * 7
            span = pa.struct(
                [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
                 ("votes", pa.int32()), ("features", pa.list_(pa.int32()))]
            )
            kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(span)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    return texts(docs, "doc_id").mapInArrow(run, FOUND)


def reliabilities(counts: dict[tuple[int, int], int], p: PersonalData) -> dict[tuple[int, int], float]:
    """Posterior of each (kind, votes) pattern by expectation-maximisation.

    Each labeler of each kind has two error rates. They are smoothed towards, and bounded
    by, being right more often than wrong, so the classes cannot change places.
    """
    out: dict[tuple[int, int], float] = {}
    for kind in range(len(KINDS)):
        own = sorted(code for k, code in counts if k == kind)
        if not own:
            continue
        n = np.array([counts[kind, code] for code in own], float)
        v = np.array([[code // 3 ** (len(LABELERS) - 1 - j) % 3 - 1 for j in range(len(LABELERS))] for code in own])
        yes, no = v == 1, v == 0
        prior, hit, alarm = 0.7, np.full(len(LABELERS), 0.8), np.full(len(LABELERS), 0.3)
        for _ in range(p.rounds):
            odds = np.log(prior / (1 - prior)) + yes @ np.log(hit / alarm) + no @ np.log((1 - hit) / (1 - alarm))
            good = 1 / (1 + np.exp(-odds))
            w, u = n * good, n * (1 - good)
            hit = (w @ yes + 4) / (w @ (yes | no) + 5)
            alarm = (u @ yes + 1.5) / (u @ (yes | no) + 5)
            hit, alarm = np.clip(hit, 0.55, 0.99), np.clip(alarm, 0.01, 0.5)
            prior = float(np.clip((w.sum() + 3.5) / (n.sum() + 5), 0.05, 0.95))
        out |= {(kind, code): float(g) for code, g in zip(own, good)}
    return out


def train(spans: DataFrame, p: PersonalData) -> np.ndarray:
    """Weights of the span classifier, the last one its bias.

    Patterns of all candidates are counted; the classifier learns the posterior of
    ``p.sample`` candidates drawn by hash.
    """
    patterns = spans.groupBy("s.kind", "s.votes").count().collect()
    posterior = reliabilities({(r[0], r[1]): r[2] for r in patterns}, p)
    sample = (
        spans.select("s.kind", "s.votes", "s.features", F.xxhash64("doc_id", "s.start", "s.kind").alias("h"))
        .orderBy("h", "kind", "votes")
        .limit(p.sample)
        .collect()
    )
    weights = np.zeros(p.features + 1)
    if not sample:
        return weights
    goal = np.array([posterior[r["kind"], r["votes"]] for r in sample])
    counts = np.array([len(r["features"]) for r in sample])
    index = np.concatenate([r["features"] for r in sample])
    row = np.repeat(np.arange(len(sample)), counts)
    step, speed = 1.0, np.full(p.features + 1, 1e-8)
    for _ in range(p.epochs):
        score = np.bincount(row, weights[index], len(sample)) + weights[-1]
        error = 1 / (1 + np.exp(-score)) - goal
        slope = np.append(np.bincount(index, error[row], p.features), error.sum()) / len(sample)
        slope[:-1] += 1e-5 * weights[:-1]
        speed += slope * slope
        weights -= step * slope / np.sqrt(speed)
    return weights


def detect(spark: SparkSession, docs: DataFrame, p: PersonalData = PersonalData()) -> DataFrame:
    """doc_id, base counts n_email to n_phone, base_sha256, spans and n_added per document.

    A null or empty text has no span. Rows that share an id, or repeat, are searched each
    for itself; a null id stays null; an empty table gives an empty result; other columns
    are ignored. Places are code points, ends exclusive; a candidate that touches a base
    span is left to it.
    """
    tables = Tables(spark, "pii")
    found = tables.keep(find(docs, p), "found")
    spans = found.select("doc_id", F.explode("spans").alias("s"))
    weights = spark.sparkContext.broadcast(train(spans, p))

    def run(batches):
        table = weights.value
        for batch in batches:
            names, added = [], []
            for spans in batch.column(6).to_pylist():
                kept = []
                for s in spans:
                    score = table[s["features"]].sum() + table[-1]
                    if s["base"] or 1 / (1 + np.exp(-score)) >= p.threshold:
                        kept.append((s["kind"], s["start"], s["end"]))
                names.append(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(kept)))
                added.append(len(kept) - sum(s["base"] for s in spans))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array(names, pa.string()), pa.array(added, pa.int64())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
            )

    schema = FOUND[: FOUND.index("spans")] + "spans string, n_added long"
    return found.mapInArrow(run, schema)
