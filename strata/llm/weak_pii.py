"""Personal data by weak supervision (operator 11).

Each text gives candidate spans of four kinds: those that the base rules accept
(they always stay) and looser ones: numbers that fail a base rule, written-out
e-mail addresses, IPv6 addresses, dotted cards, phone numbers in national form.
Labelers of three sorts vote on each candidate (yes, no, or no opinion): regular
expressions (the base rule, the usual form, the edges), gazetteers (top-level
domains, card issuers, calling codes, number ranges) and the words before the
span (for and against).  Votes are counted per kind and vote pattern over all
documents; expectation-maximisation on these counts (at most 3 ** 6 per kind)
estimates how often each labeler is right or silent on true and on false
candidates, and so the chance that a pattern means a true one.  A logistic
classifier of a candidate's form and surroundings learns these chances; it is
fitted on at most ``SAMPLE`` distinct candidates, those with the smallest hashes.
Candidates that it puts at ``ACCEPT`` or more are added to the base spans.

Texts are scanned once; what later passes read is the candidates.

Cases: a null text counts as empty; texts of any length are scanned whole, in
time that grows with their length; a candidate that overlaps a base span of any
kind is none; of added spans that overlap the one with the higher score stays, of
equal scores the one that begins first, then the kind listed first; repeated rows
are rows of their own; equal texts get equal spans; a null id is an id like any
other; an empty table, or one without candidates, adds no spans; extra columns
do not clash, whatever their names.
"""

from __future__ import annotations

import ipaddress
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

SAMPLE = 20_000
ACCEPT = 0.5
PLACES = 1 << 12  # hashed features
ROUNDS = 300  # of either fit, at most
CONTEXT = 48  # characters before a span that are searched for words

Span = tuple[int, int]

# --- base rules -------------------------------------------------------------------

# The patterns of the contract.  Runs are taken whole and given back
# never, which changes no match and keeps scans linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def digits_of(text: str) -> str:
    return NOT_DIGIT.sub("", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def small_part(part: str) -> bool:
    own = part.lstrip("0")
    return len(own) <= 3 and int(own or 0) <= 255


def base_spans(text: str) -> tuple[list[list[Span]], list[list[Span]]]:
    """Per kind: what the base rules accept, and the matches that fail a check."""
    good: list[list[Span]] = [list(emails(text)), [], [], []]
    failed: list[list[Span]] = [[], [], [], []]
    for m in QUAD.finditer(text):
        (good if all(map(small_part, m.group().split("."))) else failed)[IP].append(m.span())
    for m in DIGITS.finditer(text):
        own = digits_of(m.group())
        (good if 14 <= len(own) <= 19 and luhn(own) else failed)[CARD].append(m.span())
    if "+" in text:
        for m in PLUS.finditer(text):
            (good if 10 <= len(digits_of(m.group())) <= 15 else failed)[PHONE].append(m.span())
    return good, failed


# --- looser candidates --------------------------------------------------------------

_AT = r"(?: ?[(\[{<] ?at ?[)\]}>] ?| at )"
_DOT = r"(?: ?[(\[{<] ?dot ?[)\]}>] ?| dot )"
WRITTEN = re.compile(rf"{_AT}[a-z0-9-]{{1,63}}+(?:{_DOT}[a-z0-9-]{{1,63}}+)++", re.IGNORECASE | re.ASCII)
SIX = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
DOTTED = re.compile(r"(?<![0-9.])[0-9]{4}(?:\.[0-9]{4}){3}(?![0-9.])")
NATIONAL = re.compile(r"(?<![0-9+])\(?[0-9][0-9 ()./-]{5,}[0-9]")


def candidates(text: str, good: list[list[Span]], failed: list[list[Span]]) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, accepted by a base rule) of every span to be judged."""
    taken = sorted(s for spans in good for s in spans)
    starts, ends, top = [s for s, _ in taken], [], 0
    for _, e in taken:
        top = max(top, e)
        ends.append(top)

    def free(start: int, end: int) -> bool:
        i = bisect_left(starts, end)
        return i == 0 or ends[i - 1] <= start

    for kind, spans in enumerate(good):
        for s, e in spans:
            yield kind, s, e, True
    loose: list[tuple[int, int, int]] = []
    for m in WRITTEN.finditer(text):
        start = m.start()
        while start > 0 and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            loose.append((EMAIL, start, m.end()))
    loose += [(IP, s, e) for s, e in failed[IP] if e - s <= 15]
    loose += [(IP, *m.span()) for m in SIX.finditer(text) if m.end() - m.start() > 4]
    loose += [(CARD, s, e) for s, e in failed[CARD] if 13 <= len(digits_of(text[s:e])) <= 19]
    loose += [(CARD, *m.span()) for m in DOTTED.finditer(text)]
    loose += [(PHONE, s, e) for s, e in failed[PHONE] if 7 <= len(digits_of(text[s:e])) <= 15]
    for m in NATIONAL.finditer(text):
        own = m.group()
        if 7 <= len(digits_of(own)) <= 15 and not own.isdigit():
            loose.append((PHONE, *m.span()))
    for kind, s, e in loose:
        if free(s, e):
            yield kind, s, e, False


# --- labelers -----------------------------------------------------------------------

LABELERS = ("rule", "form", "edges", "gazetteer", "words for", "words against")

TOP_LEVEL = frozenset("com org net edu gov info biz io de fr es uk eu it nl ch at be pl pt se no dk fi us ca au jp cn in br mx ru".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
           "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "351", "353", "358", "420")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "30", "36", "38", "22", "23", "24", "25", "26", "27")
FOR = (
    frozenset("mail email e write contact reach correo escriba kontakt schreiben courriel contactez adresse address".split()),
    frozenset("ip host server address addr node ping servidor rechner serveur adresse proxy gateway login".split()),
    frozenset("card visa mastercard amex credit debit payment tarjeta karte kreditkarte carte bancaire pago zahlung".split()),
    frozenset("phone tel telephone call mobile cell fax dial whatsapp telefon anrufen handy llamar telefono móvil appelez téléphone".split()),
)
AGAINST = frozenset(
    "version release v order invoice isbn issn no nr page pages ref id serial part model score total section chapter "
    "pedido factura página rechnung seite bestellung commande facture figure table year date".split()
)
FORM = (
    re.compile(r"(?:\.|dot\W{0,2}|\W)([A-Za-z]{2,24})$"),
    re.compile(r"(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}|[0-9A-Fa-f:]+"),
    re.compile(r"[0-9]{15,16}|[0-9]{4}([ .-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}"),
    re.compile(r"\+?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ ./-][0-9]{2,4}){2,4}"),
)
DATE = re.compile(r"[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2,4}")
WORD = re.compile(r"[^\W\d_]+")


def votes(text: str, kind: int, start: int, end: int, base: bool, before: list[str]) -> tuple[int, ...]:
    """One vote per labeler: 1 (personal data), -1 (not) or 0 (no opinion)."""
    own = text[start:end]
    digits = digits_of(own)
    rule = 1 if base else -1
    form = 1 if FORM[kind].fullmatch(own) else -1
    gazetteer = 0
    if kind == EMAIL:
        label = FORM[EMAIL].search(own)
        form = 1 if label else -1
        gazetteer = 1 if label and label.group(1).lower() in TOP_LEVEL else 0
        rule = 1 if base else 0
    elif kind == IP and ":" in own:
        try:
            ipaddress.IPv6Address(own)
            rule, gazetteer = 1, 1 if own.lower().startswith(("2", "3", "fe80", "fc", "fd")) else 0
        except ValueError:
            rule, form = -1, -1
    elif kind == IP:
        parts = [int(p.lstrip("0")[:4] or 0) for p in own.split(".")]
        # All parts small: a version or a section number rather than an address.
        gazetteer = -1 if max(parts) < 20 or parts[0] in (0, 255) else 1
    elif kind == CARD:
        gazetteer = 1 if digits.startswith(ISSUERS) else -1
        rule = 1 if luhn(digits) and 14 <= len(digits) <= 19 else -1
    else:
        rule = 1 if base else (-1 if own.startswith("+") else 0)
        if DATE.fullmatch(own):
            form = -1
        elif own.startswith("+") or own.startswith("00"):
            gazetteer = 1 if digits.removeprefix("00").startswith(CALLING) else -1
    left, right = text[start - 1 : start], text[end : end + 1]
    glued = left.isalnum() or right.isalnum() or left in ("#", "$", "€", "=", "/") and left != ""
    known = set(before)
    return (rule, form, -1 if glued else 1, gazetteer, int(bool(known & FOR[kind])), -int(bool(known & AGAINST)))


def pattern(own: tuple[int, ...]) -> int:
    code = 0
    for v in own:
        code = 3 * code + v + 1
    return code


def unpattern(code: int) -> list[int]:
    out = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        out.append(v - 1)
    return out[::-1]


def char_class(c: str) -> str:
    return "edge" if not c else "blank" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c


def features(text: str, kind: int, start: int, end: int, own: tuple[int, ...], before: list[str]) -> list[int]:
    """Hashed features of a candidate's form and surroundings, each once."""
    span = text[start:end]
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: f"9{min(len(m.group()), 20)}", span))
    after = WORD.search(text[end : end + CONTEXT])
    found = [
        "bias",
        f"shape {shape}",
        f"length {min(end - start, 40) // 4}",
        f"digits {len(digits_of(span))}",
        f"first {span[:1]}",
        f"left {char_class(text[start - 1 : start])}",
        f"right {char_class(text[end : end + 1])}",
        f"next {after.group().lower() if after else ''}",
        f"checked {own[0]}",
        f"form {own[1]}",
        f"range {own[3]}",
        *[f"word {w}" for w in before[-3:]],
    ]
    # The bias of each kind has a place of its own; the others share the rest.
    places = {kind} | {4 + zlib.crc32(f"{kind} {f}".encode()) % (PLACES - 4) for f in found[1:]}
    return sorted(places)


def scan(text: str) -> list[tuple[int, int, int, bool, int, list[int]]]:
    """(kind, start, end, base, vote pattern, features) of every candidate."""
    out = []
    for kind, start, end, base in candidates(text, *base_spans(text)):
        before = [w.lower() for w in WORD.findall(text[max(0, start - CONTEXT) : start])]
        own = votes(text, kind, start, end, base, before)
        out.append((kind, start, end, base, pattern(own), features(text, kind, start, end, own, before)))
    return out


# --- models on the driver -------------------------------------------------------------

# What each labeler does before any candidate is seen: shares of no, silent, yes
# on false and on true candidates; they count as STRENGTH candidates.  A check
# says much, a form or an edge little: other numbers have the same.
PRIOR = np.array(
    [
        [[0.80, 0.15, 0.05], [0.05, 0.25, 0.70]],  # rule
        [[0.40, 0.20, 0.40], [0.10, 0.10, 0.80]],  # form
        [[0.40, 0.20, 0.40], [0.10, 0.10, 0.80]],  # edges
        [[0.50, 0.20, 0.30], [0.10, 0.30, 0.60]],  # gazetteer
        [[0.01, 0.89, 0.10], [0.01, 0.59, 0.40]],  # words for
        [[0.40, 0.59, 0.01], [0.05, 0.94, 0.01]],  # words against
    ]
)
# A number that fails its checksum is hardly ever a card.
CARD_RULE = np.array([[0.98, 0.01, 0.01], [0.01, 0.01, 0.98]])
STRENGTH = 10.0


def priors(kind: int) -> np.ndarray:
    own = PRIOR.copy()
    if kind == CARD:
        own[0] = CARD_RULE
    return own


@dataclass
class Reliability:
    """Of one kind: share of true candidates, and per labeler and truth the
    shares of the votes (no, silent, yes)."""

    share: float
    rates: np.ndarray  # labeler, truth, vote
    truth: dict[int, float]  # chance that a candidate with this vote pattern is true


def em(counts: dict[int, int], prior: np.ndarray = PRIOR) -> Reliability:
    """Reliabilities from the counts of vote patterns, without any true label."""
    codes = sorted(counts)
    seen = np.array([unpattern(c) for c in codes]).reshape(-1, len(LABELERS)) + 1
    weight = np.array([counts[c] for c in codes], float)
    rates = prior.copy()
    share, truth = 0.5, np.zeros(len(codes))
    places = np.arange(len(LABELERS))
    for _ in range(ROUNDS):
        with np.errstate(under="ignore"):
            logs = np.log(rates)[places[None], :, seen].sum(axis=1) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))
        if len(new) and np.abs(new - truth).max() < 1e-10:
            break
        truth = new
        share = float((weight @ truth + 1) / (weight.sum() + 2))
        for a in places:
            for t, own in enumerate((weight * (1 - truth), weight * truth)):
                held = np.bincount(seen[:, a], weights=own, minlength=3) + STRENGTH * prior[a, t]
                rates[a, t] = held / held.sum()
    return Reliability(share, rates, dict(zip(codes, truth.tolist())))


def logistic(rows: list[list[int]], targets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights of binary features for the chances ``targets``, by accelerated
    gradient steps on the penalised log-loss."""
    w = np.zeros(PLACES)
    if not rows:
        return w
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weights = weights / weights.sum()
    longest = max(len(r) for r in rows)
    step, penalty = 4.0 / longest, 1e-5
    ahead, momentum = w, 1.0
    for _ in range(ROUNDS):
        margin = np.bincount(owner, weights=ahead[flat], minlength=len(rows))
        slope = weights * (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - targets)
        gradient = np.bincount(flat, weights=slope[owner], minlength=PLACES) + penalty * ahead
        new = ahead - step * gradient
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = new + (momentum - 1) / following * (new - w)
        w, momentum = new, following
    return w


@dataclass
class Model:
    reliabilities: dict[int, Reliability] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(PLACES))

    def score(self, kind: int, places: list[int]) -> float:
        if kind not in self.reliabilities:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.weights[places].sum(), -35, 35))))


# --- operator -------------------------------------------------------------------------

CANDIDATES = "array<struct<kind:int,start:long,end:long,base:boolean,pattern:int,features:array<int>>>"
SPANS = "array<struct<kind:string,start:long,end:long,base:boolean,score:double>>"

_CANDIDATE = pa.struct(
    [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("pattern", pa.int32()), ("features", pa.list_(pa.int32()))]
)
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])


def scanned(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, candidates of every row, written once: texts are not read again."""
    checkpoint_dir(docs.sparkSession)
    names = list(_CANDIDATE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip((f.name for f in names), c)) for c in scan(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(_CANDIDATE))], ["key", "candidates"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"key {kind}, candidates {CANDIDATES}").checkpoint()


def fit(found: DataFrame) -> Model:
    """Reliabilities from all candidates of ``scanned`` rows, and the classifier."""
    each = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.pattern", "c.features")
    alike = each.groupBy("kind", "pattern", "features").agg(F.count(F.lit(1)).alias("n"))
    counts: dict[int, dict[int, int]] = {}
    for r in alike.groupBy("kind", "pattern").agg(F.sum("n").alias("n")).collect():  # at most 4 * 3 ** 6 rows
        counts.setdefault(r["kind"], {})[r["pattern"]] = r["n"]
    own = {kind: em(seen, priors(kind)) for kind, seen in counts.items()}
    # A stated bound: the distinct candidates with the smallest hashes, with their numbers.
    hashed = F.xxhash64(F.lit("sample"), "kind", "pattern", "features")
    rows = alike.withColumn("hash", hashed).orderBy("hash", "kind", "pattern", "features").limit(SAMPLE).collect()
    targets = np.array([own[r["kind"]].truth[r["pattern"]] for r in rows])
    return Model(own, logistic([r["features"] for r in rows], targets, np.array([r["n"] for r in rows], float)))


def chosen(found: list[dict], model: Model) -> list[dict]:
    """Base spans and the added ones, by start, then kind, then end."""
    spans = [(c["start"], c["kind"], c["end"], c["base"], model.score(c["kind"], c["features"])) for c in found]
    kept = [s for s in spans if s[3]]
    added: list[Span] = []  # disjoint, by start
    for s in sorted((s for s in spans if not s[3] and s[4] >= ACCEPT), key=lambda s: (-s[4], s[0], s[1], s[2])):
        i = bisect_left(added, (s[0], s[2]))
        if (i == 0 or added[i - 1][1] <= s[0]) and (i == len(added) or added[i][0] >= s[2]):
            added.insert(i, (s[0], s[2]))
            kept.append(s)
    return [{"kind": KINDS[k], "start": a, "end": e, "base": b, "score": p} for a, k, e, b, p in sorted(kept)]


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and spans (kind, start, end, base, score) of every row of ``docs``;
    places in code points, end exclusive."""
    found = scanned(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(fit(found))  # PLACES numbers and the reliabilities

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            spans = [chosen(own.as_py(), model) for own in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN))], [key, "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return found.mapInArrow(run, f"`{key}` {kind}, spans {SPANS}")


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: str, spans: list[dict]) -> str:
    """The text with each stretch of spans replaced by the kind that begins it."""
    out, done = [], 0
    for s in spans:
        if s["start"] >= done:
            out += [text[done : s["start"]], f"<{s['kind']}>"]
        done = max(done, s["end"])
    return "".join([*out, text[done:]])
