"""Personal data: base patterns, and further spans chosen by boosted trees.

Base spans (email, ip, card, phone) follow fixed patterns and checks and always stay.
Beyond them, high-recall generators propose spans that may overlap one another: written-out
addresses, telephone numbers without a plus, long digit groups, IPv6 addresses (shortened too),
identity and account numbers (IBANs of a listed country by its length), keys, and whatever stands
behind a word such as password, token or key. Boosted trees see a candidate's format (lengths, digit groups,
checksums, mixture of characters) and its context (words before it, neighbouring characters);
per kind, the threshold is calibrated on held-out examples to ``PRECISION``. Chosen spans that
overlap a base span or a better one are dropped.

There are no labelled spans in the tables, so the trees learn from ``EXAMPLES`` examples
that this module writes itself from a seed: sentences with personal data, and sentences
with order numbers, versions, dates, measures and the like in the same formats.

Offsets are code points, ends exclusive. Null and empty texts have no spans. One row per input
row: repeated rows get equal results, null ids are carried through; other columns are not read.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Calibrated
from .common import settings


#: The order of kinds at equal starts; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "id", "secret")
PRECISION = 0.97
EXAMPLES = 9000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a digit run matches from its start or not at all, so later starts within it are not tried
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str):
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            low = m.end()
        at = text.find("@", max(at + 1, low))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    out = [(s, 0, e) for s, e in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        if 12 <= len(d := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(out)


#: Generators of candidates: kind and pattern. They are meant to find too much.
GENERATORS = [
    (0, re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[A-Za-z0-9-]{1,64}(?:(?:\.|\x20?[\[(]\x20?(?:dot|DOT)\x20?[\])]\x20?)[A-Za-z0-9-]{1,64}){1,8}")),
    (2, re.compile(r"(?<![0-9-])[0-9]{4}(?:[\x20.-]?[0-9]{4}){2}[\x20.-]?[0-9]{1,7}(?![0-9-])")),
    (3, re.compile(r"(?<![0-9+.-])\(?[0-9]{2,5}\)?[\x20./-]{1,2}[0-9]{2,8}(?:[\x20.-][0-9]{2,5}){1,3}(?![0-9-])")),
    (3, re.compile(r"(?<![0-9+.A-Za-z-])[0-9]{9,12}(?![0-9A-Za-z.-])")),
    (4, re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    (5, re.compile(r"(?<![A-Za-z0-9])[A-Z]{4}[A-Z0-9]{16}(?![A-Za-z0-9])")),
    (5, re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{16,}+(?![A-Za-z0-9])")),
    (5, re.compile(r"(?<![A-Za-z0-9_-])(?:gh[pousr]_|github_pat_|sk-|xox[abprs]-|AIza|eyJ)[A-Za-z0-9_.-]{15,}+(?<![.-])")),
]
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,8}[0-9A-Fa-f]{0,4}(?!:?[0-9A-Za-z])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
#: Characters of an IBAN by country (fixed values).
IBAN_LENGTHS = {
    n: codes.split()
    for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
}
_IBAN_LENGTH = {code: n for n, codes in IBAN_LENGTHS.items() for code in codes}
#: What stands behind such a word, within quotes or up to a blank, may be a secret.
_MARKS = ("passw", "passphrase", "pwd", "secret", "token", "key", "credential", "login")
_MARKED = re.compile(r"(?:passw(?:or)?d|passphrase|pwd|secret|token|key|credentials?|login)[\"']?\x20{0,2}(?:[:=]{1,2}>?|is\b)?\x20{0,2}(?:\"([^\"\n]{4,})\"|'([^'\n]{4,})'|(?=([^\s\"'])[^\s]{3}))", re.IGNORECASE | re.ASCII)
_RUN = re.compile(r"[^\s]+", re.ASCII)
_TRAILING = frozenset(".,;:)]}>\"'")
#: Of longer spans the beginning is described, and how long they are.
DESCRIBED = 256
#: Within a longer run without blanks, as of base64, only a mark with a sign or blank behind it is one.
LONG_RUN = 1024
#: A value that is itself a mark with a sign, as in "login password=...", is only the name of the next one.
_NAMED = re.compile(r"(?:passw(?:or)?d|passphrase|pwd|secret|token|key|credentials?|login)[\"']?\x20{0,2}[:=]", re.IGNORECASE | re.ASCII)
_PREFIX = re.compile(r"gh[pousr]_|github_pat_|sk-|xox[abprs]-|AIza|eyJ")
_HEX = frozenset("0123456789abcdefABCDEF")
_SIGN = re.compile(r"(?:[:=]>?|\bis)\x20{0,2}[\"']?$")
_CONTEXT = [
    re.compile(p, re.IGNORECASE)
    for p in (
        r"mail|contact|write|correo|courriel",
        r"tel|phone|call|fax|mobil|whatsapp|cell",
        r"card|visa|master|credit|debit|karte|carte|tarjeta|payment",
        r"\bip\b|host|server|address|ipv6",
        r"passw|token|secret|api|key|credential|login",
        r"ssn|social|passport|iban|account|identity|tax|ausweis",
        r"order|invoice|ticket|part|model|serial|isbn|sku|ref|no\.|number|bestell",
        r"version|release|build|commit|hash|checksum|sha|md5|digest",
        r"date|time|year|page|chapter|pop|total|sum|size|score|seed",
    )
]


def _ipv6(text: str):
    for m in _IPV6.finditer(text):
        s = m.group()
        if s.endswith(":") and not s.endswith("::"):  # the sentence's own colon
            s = s[:-1]
        try:
            ipaddress.IPv6Address(s)
        except ValueError:
            continue
        yield m.start(), m.start() + len(s)


def _ibans(text: str):
    """Account numbers; behind a listed country's length the text goes on with other words."""
    for m in _IBAN.finditer(text):
        left, end = _IBAN_LENGTH.get(m.group()[:2], 0), m.start()
        while left and end < m.end():
            left -= text[end] != " "
            end += 1
        whole = left == 0 and end > m.start() and (end == m.end() or not text[end].isalnum())
        yield m.start(), end if whole else m.end()


def _marked(text: str):
    low = text.lower()
    if any(w in low for w in _MARKS):
        at = run = close = begun = 0
        while m := _MARKED.search(text, at):
            start, end = m.span(m.lastindex)
            if m.lastindex == 3:
                if start >= run:  # else the same run as before: where it ends is known
                    begun, run = start, _RUN.match(text, start).end()
                    close = run
                    while close > start and text[close - 1] in _TRAILING:
                        close -= 1
                end = max(start, close)
                if run - begun > LONG_RUN and not any(c in ":= >" for c in text[m.start() : start]):
                    at = start
                    continue
            if end - start >= 4 and not _NAMED.match(text, start):
                yield start, end
            at = start  # a value may be a mark itself, as in "secret key: ..."


def mod97(s: str) -> bool:
    """The check of an IBAN."""
    c = s.replace(" ", "")
    return len(c) > 4 and c.isascii() and c.isalnum() and int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 == 1


def candidates(text: str) -> list[tuple[int, int, int]]:
    found = {(m.start(), kind, m.end()) for kind, p in GENERATORS for m in p.finditer(text)}
    for kind, spans in ((1, _ipv6(text)), (4, _ibans(text)), (5, _marked(text))):
        found.update((s, kind, e) for s, e in spans)
    return sorted(found)


def describe(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context features of one candidate."""
    s, before, after = text[start : min(end, start + DESCRIBED)], text[max(0, start - 40) : start], text[end : end + 1]
    digits = _NOT_DIGIT.sub("", s)
    groups = re.findall(r"[0-9]+", s)
    near = before[-16:]
    labels = re.findall(r"[A-Za-z]+", s)
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        end - start, len(digits), sum(c.isalpha() for c in s), sum(c.isupper() for c in s), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(set(s)) / len(s), float(luhn(digits)) if digits else 0.0, float("(" in s), s.count("-"), s.count("."), s.count(" "), float(s.startswith("0")), float(s.startswith("(")),
        float(kind == 4 and len(s) < 50 and mod97(s)), float(_IBAN_LENGTH.get(s[:2]) == len(s.replace(" ", ""))), s.count(":"), float(bool(_SIGN.search(before))), sum(not c.isalnum() and c != " " for c in s),
        len(labels), len(labels[-1]) if labels else 0, float(kind == 0 and bool(labels) and labels[-1].lower() in _ENDINGS),
        float(s.islower()), float(bool(digits) and any(c.isalpha() for c in s)), float(bool(_PREFIX.match(s))), float(set(s) <= _HEX),
        float(s.startswith("AKIA")), float(before[-1:] in "=:\"'"), float(after.isalnum()), float(after in "\"'"),
        *(float(bool(p.search(before))) for p in _CONTEXT), *(float(bool(p.search(near))) for p in _CONTEXT),
    ]


#: Common last labels of domains (fixed values).
_ENDINGS = frozenset("com org net edu gov info io biz eu de fr es it at ch nl be uk us ca au jp br pl se no dk fi pt".split())
_TO_LETTERS = str.maketrans("0123456789", "QRSTUVWXYZ")


def _examples(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and kinds of candidates in generated sentences; each has one marked span."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    dig = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    low = lambda k: "".join(chr(97 + int(i)) for i in rng.integers(0, 26, k))
    up = lambda k: "".join(pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(k))
    hexa = lambda k: "".join(pick("0123456789abcdef") for _ in range(k))
    alnum = lambda k: "".join(pick("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(k))
    either = lambda t: t.upper() if rng.random() < 0.3 else t

    def card():
        d = dig(15)
        return d + next(c for c in "0123456789" if luhn(d + c))

    def grouped(d):
        return pick([" ", "-", ""]).join(d[i : i + 4] for i in range(0, len(d), 4))

    def iban():
        land = pick(["DE", "FR", "ES", "GB", "NL", "IT", "AT", "CH", "BE", "PL", "PT", "SE"])
        n = _IBAN_LENGTH[land] - 4
        body = {"GB": up(4).translate(_TO_LETTERS) + dig(n - 4), "NL": up(4).translate(_TO_LETTERS) + dig(n - 4), "IT": "X" + dig(n - 1), "FR": dig(n - 3) + "M" + dig(2)}.get(land) or dig(n)
        check = 98 - int("".join(str(int(x, 36)) for x in body + land + "00")) % 97
        c = f"{land}{check:02d}{body}"
        return pick([c, " ".join(c[i : i + 4] for i in range(0, len(c), 4))])

    def short_ipv6():
        k = int(rng.integers(1, 6))
        head = pick(["2001:db8", "fe80", "2a02:" + hexa(4), hexa(4)])
        return either(f"{head}::" + ":".join(hexa(int(rng.integers(1, 5))) for _ in range(k)))

    def written_address():
        at, dot = pick([" [at] ", " (at) ", "[at]", "(at)", " [AT] "]), pick([".", " [dot] ", " (dot) ", "[dot]"])
        name = low(int(rng.integers(1, 9))) + pick(["", "", "." + low(int(rng.integers(2, 9))), "_" + low(4), dig(2), "-" + low(3)])
        host = low(int(rng.integers(2, 12))) + pick(["", "", "-" + low(5), dot + low(4)])
        return name + at + host + dot + pick(sorted(_ENDINGS))

    def filler():
        w = low(int(rng.integers(2, 9)))
        return pick([w, w, w, w.capitalize(), w + ",", w + ":", w.upper()])

    def password():
        w, d = low(int(rng.integers(4, 9))), dig(int(rng.integers(1, 5)))
        return pick([w + d, w.capitalize() + d + pick("!?$#@%&*"), w.capitalize() + pick("!?$#@%&*") + d, alnum(int(rng.integers(8, 33))), f"{w}-{low(5)}-{low(4)}", w + low(4), w[:3] + pick("!$#%&*") + alnum(5)])

    def local():
        a, b, c = dig(3), dig(3), dig(4)
        return pick([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{a} {b} {c}", f"0{dig(9)}"])

    good = [
        lambda: (pick(["mail me at ", "contact: ", "", "write to ", "reach us under ", "reply to: ", "send it to ", "e-mail: "]), written_address()),
        lambda: (pick(["host ", "ip address ", "server at ", ""]), either(":".join(hexa(4) for _ in range(8)))),
        lambda: (pick(["host ", "ip address ", "server at ", "ipv6 ", "", "connect to "]), short_ipv6()),
        lambda: (pick(["card number ", "visa ", "pay with card ", "credit card: "]), grouped(card())),
        lambda: (pick(["call ", "tel ", "phone: ", "fax ", "mobile ", "whatsapp "]), local()),
        lambda: (pick(["ssn ", "social security number ", "tax identity "]), f"{dig(3)}-{dig(2)}-{dig(4)}"),
        lambda: (pick(["iban ", "account ", "pay to account "]), iban()),
        lambda: (pick(["iban ", "iban: ", "account ", "pay to account ", "", low(5) + " "]), iban()),
        lambda: (pick(["key ", "", "", low(5) + " "]), "AKIA" + pick([t := up(16), t, t.translate(_TO_LETTERS)])),
        lambda: (pick(["password=", 'token = "', "secret: ", "api key ", "login token "]), either(hexa(int(pick([16, 18, 20, 24, 28, 32, 40, 48, 64, 96]))))),
        lambda: (pick(["password: ", "password=", "password is ", "pwd: ", "secret: ", "api_key=", "api key: ", 'token = "', "my login password is ", "credentials: ", "passwd="]), password()),
        lambda: (pick(["", "", "key ", "token: ", "use ", low(5) + " ", "Authorization: ", "authorization token: ", "export TOKEN=", "bearer "]), pick(["ghp_", "gho_", "sk-", "xoxb-", "AIza", "eyJ"]) + alnum(int(rng.integers(16, 60)))),
    ]
    bad = [
        lambda: (pick(["see note ", "type ", "", "we met ", "the value ", "mail "]), f"{low(int(rng.integers(2, 9)))}{pick([' (at) ', ' [at] ', '(at)'])}{low(int(rng.integers(2, 9)))}.{low(int(rng.integers(5, 12)))}"),
        lambda: (pick(["the ", "a ", "forgot ", "this "]) + pick(["password ", "token ", "key ", "secret ", "login ", "credentials "]), pick([low(int(rng.integers(4, 10))), f"count {dig(3)}", "points", "reset", "page", "value", "itself", "manager"])),
        lambda: (pick(["the password is ", "the key is ", "the secret is ", "key: ", "token: "]), pick(["wrong", "required", "missing", "that", "long", "safe", "expired", "invalid", "simple", "none", "needed", "stored", "below", "this", "when"])),
        lambda: (pick(["class ", "ratio ", "see ", "use ", "verse "]), pick([f"{pick('abcdef')}::{pick('abcdef')}", "::", f"::{pick('abcdef')}{pick('abcdef')}"])),
        lambda: (pick(["checksum ", "digest "]), ":".join(hexa(4) for _ in range(8))),
        lambda: (pick(["order ", "invoice no. ", "total ", "serial ", "isbn "]), grouped(dig(16))),
        lambda: (pick(["order ", "part ", "page ", "date ", "version ", "isbn ", "", low(5) + " "]), pick([f"{dig(3)}-{dig(3)}-{dig(4)}", f"20{dig(2)}-{dig(2)}-{dig(2)}", f"{dig(2)}.{dig(2)}.20{dig(2)}", f"{dig(3)} {dig(3)} {dig(3)}", dig(10)])),
        lambda: (pick(["part ", "model ", "order ", "ref "]), f"{dig(3)}-{dig(2)}-{dig(4)}"),
        lambda: (pick(["serial ", "sku ", "model "]), f"{up(2)}{dig(2)} {up(4)} {up(4)} {up(4)}"),
        lambda: (pick(["serial ", "sku ", "model ", "part ", ""]), f"{pick(['DE', 'FR', 'ES', 'GB', 'XY', 'AB'])}{dig(int(rng.integers(12, 26)))}"),
        lambda: (pick(["serial ", "model ", "", "part "]), "".join(pick("BCDEFGHXYZ") for _ in range(4)) + pick([t := up(16), t, t.translate(_TO_LETTERS)])),
        lambda: (pick(["commit ", "sha ", "md5 ", "checksum ", "build ", "hash "]), either(hexa(int(pick([16, 20, 24, 32, 40, 64, 96]))))),
        lambda: (pick(["order ", "total ", "seed ", "number ", ""]), dig(int(rng.integers(16, 40)))),
    ]
    x, y, kinds = [], [], []
    while len(y) < n:
        label = int(rng.random() < 0.5)
        lead, span = pick(good if label else bad)()
        text = " ".join(filler() for _ in range(int(rng.integers(0, 6)))) + pick([" ", " ", ". ", ""]) + lead
        at, text = len(text), text + span + pick(['"', " ", ". ", ", ", ""]) + low(4)
        for s, k, e in candidates(text):
            if s < at + len(span) and e > at:
                whole = s >= at and e <= at + len(span) and e - s >= 0.9 * len(span)
                x.append(describe(text, s, k, e))
                y.append(int(label and whole))
                kinds.append(k)
    return np.array(x, np.float64), np.array(y, np.float64), np.array(kinds)


@lru_cache(1)
def train() -> Calibrated:
    """The trees, the same in every process; they are grown once in each."""
    x, y, kinds = _examples(EXAMPLES)
    return Calibrated(x, y, kinds, len(KINDS), PRECISION, trees=150, depth=4)


def all_spans(text: str, base: list[tuple[int, int, int]], model: Calibrated) -> list[tuple[int, int, int]]:
    """Base spans and the chosen candidates, sorted."""
    found = candidates(text)
    starts = np.array([s for s, _, _ in base])
    ends = np.maximum.accumulate([e for _, _, e in base]) if base else np.empty(0)
    free = [c for c in found if not (k := int(np.searchsorted(starts, c[2]))) or ends[k - 1] <= c[0]]
    if not free:
        return base
    p = model.probability(np.array([describe(text, *c) for c in free], np.float64))
    taken: list[tuple[int, int, int]] = []
    good, far = [], [-1] * len(KINDS)
    for i in sorted(np.flatnonzero(p >= model.threshold[[k for _, k, _ in free]]), key=lambda i: (free[i][0], -free[i][2])):
        _, k, e = free[i]
        if e > far[k]:  # else it lies within another good one of its kind
            far[k] = e
            good.append((-p[i], free[i]))
    good.sort()
    for _, c in good:
        at = bisect_left(taken, (c[2], -1, -1))
        if not at or taken[at - 1][2] <= c[0]:  # what is taken doesn't overlap: only the last one that begins before can
            taken.insert(at, c)
    return sorted(base + taken)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for s, k, e in spans:
        if e > at:
            if s >= at:
                out += [text[at:s], f"<{KINDS[k]}>"]
            at = e
    return "".join([*out, text[at:]])


def _text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_pii(docs: DataFrame, *, with_redacted: bool = False) -> DataFrame:
    """doc_id, the base spans' counts n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id and n_secret, n_added (all
    spans beyond the base ones), n_spans and, on request, the redacted text."""
    spark = docs.sparkSession
    settings(spark)
    model = spark.sparkContext.broadcast(train())
    base_counts = [f"n_{k}" for k in KINDS[:4]]
    more = ["n_id", "n_secret", "n_added", "n_spans"]

    def run(batches):
        for b in batches:
            texts = b.column(1)
            n = len(texts)
            counts, digest, spans = np.zeros((8, n), np.int64), [hashlib.sha256(b"").hexdigest()] * n, [""] * n
            clean = texts.to_pylist() if with_redacted else None
            for i in range(n):
                text = texts[i].as_py()
                if not text:
                    continue
                base = base_spans(text)
                for _, k, _ in base:
                    counts[k, i] += 1
                digest[i] = hashlib.sha256(_text(base).encode()).hexdigest()
                every = all_spans(text, base, model.value)
                spans[i] = _text(every)
                for _, k, _ in every:
                    if k >= 4:
                        counts[k, i] += 1
                counts[6:, i] = len(every) - len(base), len(every)
                if clean is not None:
                    clean[i] = redact(text, every)
            columns = [b.column(0), *map(pa.array, counts[:4]), pa.array(digest, pa.string()), pa.array(spans, pa.string()), *map(pa.array, counts[4:])]
            names = ["doc_id", *base_counts, "base_sha256", "spans", *more]
            if clean is not None:
                columns, names = [*columns, pa.array(clean, pa.string())], [*names, "redacted"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = lambda names: ", ".join(f"{c} long" for c in names)
    schema = f"doc_id {kind}, {numbers(base_counts)}, base_sha256 string, spans string, {numbers(more)}" + ", redacted string" * with_redacted
    return docs.select(F.col("doc_id"), "text").mapInArrow(run, schema)
