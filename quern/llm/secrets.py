"""Secret scans: base rules, and character Markov models of random strings against ordinary identifiers.

Two models of order 2 over character classes of single letters, digits and signs are trained from labelled samples. A token of
MIN_TOKEN or more characters that no base span covers is a secret (`markov`) when its log-likelihood ratio a character is above a
threshold: 0, or higher where more than one in MAX_FALSE of the held-out ordinary samples (a quarter of SAMPLES) would be taken for random.
The models are trained once, on the driver.

Edge cases: a null text counts as empty and has no spans; spans count code points, end exclusive; spans of one start are told in the order of
KINDS; repeated rows are scanned each, with equal results; a text of any length is scanned whole; an empty table gives an empty result; only
doc_id and text are read.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quern.llm import textops
from quern.llm.storage import table

KINDS = ("assign", "access", "hex", "markov")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
_HEX = re.compile("[0-9a-f]{24,}")
_TOKEN = re.compile("[A-Za-z0-9+/_=-]{20,}")
MIN_TOKEN = 20
MAX_FALSE = 2000
#: Random and as many ordinary samples.
SAMPLES = 40_000

_SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_INDEX = np.full(128, -1, dtype=np.int64)
for _k, _c in enumerate(_SYMBOLS):
    _INDEX[ord(_c)] = _k
_WORDS = (
    "account action address agent array assert async backup balance banner batch block border bucket buffer build button bytes cache callback cancel "
    "channel check child class client close cloud cluster code column command commit compare config connect console container content context control "
    "convert cookie copy count create cursor data database date debug decode default delete device digest directory document domain driver editor "
    "element email enable encode endpoint engine entity error event example except execute export factory failed feature field file filter final find "
    "first flag folder format frame function future gateway generate global graph group handle handler hash header height host image import index "
    "input insert install instance integer internal invoice item iterator java kernel label language last layer layout length level library license "
    "limit line link list listener load local location lock logger login manager mapper master match member memory message method metric minute model "
    "module monitor name network node number object offset open operator option order output owner package page panel parent parse partition path "
    "pattern payment pending period permission pipeline player plugin point policy port position prefix process product profile project property "
    "protocol provider proxy public query queue random range reader record recover reference register release remote remove render report request "
    "reset resource response result retry return role route router rule sample scan schema scope screen script search second section select sender "
    "server service session setting shadow shape share signal single size socket sort source stack stage start state static status step storage "
    "store stream string style submit success summary support switch symbol system table target task template test text theme thread ticket time "
    "title tool topic total trace track transfer transform tree trigger type unique update upload user valid value vector version video view "
    "virtual visible warning watch weight widget width window worker wrapper write zone "
    "abteilung anfrage ausgabe benutzer bestellung einstellung ergebnis geschaeft gesellschaft kunde lieferung nachricht rechnung verarbeitung verbindung zeichen "
    "adresse bibliotheque commande compte connexion donnees fichier livraison mise parametre utilisateur recherche reponse "
    "archivo busqueda cliente conexion cuenta direccion entrega mensaje pedido respuesta usuario ventana"
).split()


def labelled_samples(n: int = SAMPLES, seed: int = 4) -> list[tuple[str, int]]:
    """(token, 1 if random): keys over the usual alphabets, and identifiers, paths, dates and long words."""
    r = random.Random(seed)
    alphabets = [_SYMBOLS[:64], _SYMBOLS[:62], _SYMBOLS[26:62], _SYMBOLS[:26] + _SYMBOLS[52:62], "0123456789abcdef", "0123456789ABCDEF", _SYMBOLS[:62] + "-_"]
    out = []
    for k in range(n):
        out.append(("".join(r.choices(alphabets[k % len(alphabets)], k=r.randint(20, 64))), 1))
        words = r.choices(_WORDS, k=r.randint(2, 7))
        kind = r.randrange(9)
        if kind == 0:
            token = words[0] + "".join(w.title() for w in words[1:])
        elif kind == 1:
            token = "".join(w.title() for w in words)
        elif kind in (2, 3):
            token = "_-"[kind - 2].join(words)
        elif kind == 4:
            token = "_".join(words).upper()
        elif kind == 5:
            token = "/".join(words) + f"/{r.randint(1990, 2030)}/{r.randint(1, 12):02d}"
        elif kind == 6:
            token = "".join(words)
        elif kind == 7:
            token = f"{words[0]}-{r.randint(1990, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}-{'-'.join(words[1:])}"
        else:
            token = "".join(r.choice("bcdfghklmnprstvw") + r.choice(["a", "e", "i", "o", "u", "en", "er", "on", "th", "ti", "st"]) for _ in range(r.randint(8, 24)))
        while len(token) < MIN_TOKEN:
            token += r.choice(["_", "-", ""]) + r.choice(_WORDS)
        out.append((token, 0))
    return out


class Markov:
    """Log-likelihood ratio of two order-2 character models, interpolated with lower orders."""

    def __init__(self, samples: list[tuple[str, int]]):
        train, held = samples[: len(samples) * 3 // 4], samples[len(samples) * 3 // 4 :]
        n, tables = len(_SYMBOLS), []
        share = lambda t: t / t.sum(-1, keepdims=True)
        for label in (1, 0):
            tokens = [t for t, kind in train if kind == label]
            v, size = self._values("".join(tokens)), np.array([len(t) for t in tokens])
            place = np.arange(len(v)) - np.repeat(np.cumsum(size) - size, size)  # within its token
            two, three = np.flatnonzero(place >= 1), np.flatnonzero(place >= 2)
            one = np.bincount(v, minlength=n) + 1.0
            pairs = np.bincount(v[two - 1] * n + v[two], minlength=n * n).reshape(n, n) + 0.05
            triples = np.bincount((v[three - 2] * n + v[three - 1]) * n + v[three], minlength=n**3).reshape(n, n, n) + 0.005
            tables.append(np.log(0.2 * share(one)[None, None] + 0.4 * share(pairs)[None] + 0.4 * share(triples)))
        self._ratio = tables[0] - tables[1]
        ordinary = sorted((self.ratio(t) for t, kind in held if not kind), reverse=True)
        self.threshold = max(0.0, ordinary[len(ordinary) // MAX_FALSE] if ordinary else 0.0)

    @staticmethod
    def _values(token: str) -> np.ndarray:
        return _INDEX[np.frombuffer(token.encode("ascii"), dtype=np.uint8)]

    def ratio(self, token: str) -> float:
        """Log-likelihood ratio a character."""
        v = self._values(token)
        return float(self._ratio[v[:-2], v[1:-1], v[2:]].mean()) if len(v) > 2 else float("-inf")

    def is_random(self, token: str) -> bool:
        """A random token also has a digit and a letter; words alone aren't keys."""
        return any(c.isdigit() for c in token) and any(c.isalpha() for c in token) and self.ratio(token) > self.threshold


@functools.cache
def default_model() -> Markov:
    return Markov(labelled_samples())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    low, out = text.lower() if text.isascii() else text.translate(_ASCII_LOWER), []
    if any(w in low for w in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def model_spans(text: str, base: list[tuple[str, int, int]], model: Markov) -> list[tuple[str, int, int]]:
    """Random tokens that no base span touches."""
    out, k = [], 0
    ends = sorted((s, e) for _, s, e in base)
    for m in _TOKEN.finditer(text):
        while k < len(ends) and ends[k][1] <= m.start():
            k += 1
        if any(s < m.end() and e > m.start() for s, e in ends[max(0, k - 2) : k + 3]):
            continue
        if model.is_random(m.group()):
            out.append(("markov", m.start(), m.end()))
    return out


def _scan(model: Markov):
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    told = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    def run(batches):
        for batch in batches:
            for part in textops.pieces(batch):
                rows = []
                for text in textops.texts_of(part.column("text")).to_pylist():
                    base = base_spans(text)
                    more = model_spans(text, base, model)
                    count = [sum(s[0] == k for s in base) for k in KINDS[:3]]
                    every = sorted([*base, *more], key=lambda s: (s[1], KINDS.index(s[0])))
                    rows.append((*count, hashlib.sha256(told(base).encode()).hexdigest(), told(every), len(more)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], names)

    return run


def scan(docs: DataFrame, model: Markov | None = None) -> DataFrame:
    """Spans of secrets in docs (doc_id, text). No shuffle."""
    return docs.select("doc_id", "text").mapInArrow(_scan(model or default_model()), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: secrets in every whole text."""
    return scan(table(spark, sf_dir, "documents"))


__all__ = ["Markov", "base_spans", "default_model", "labelled_samples", "model_spans", "query", "scan"]
