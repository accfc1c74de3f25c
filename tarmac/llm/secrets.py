"""Secrets in texts: fixed patterns, and tokens whose format resembles known credentials.

The patterns give the base findings and, by a bounded sample of their values, the
labelled credentials. From these one probabilistic automaton is inferred for each kind of
which there are ``LEAST_EXAMPLES`` different ones or more (``automata``). Every other token
of credential characters, of whatever make and as long as the shortest of these
credentials, is a candidate in every whole text; it is found if some automaton makes it
about as likely per character as its least likely example, and likelier by a margin than
an automaton of ordinary words does.

Defined results: a null text is empty and has no findings. Repeated rows are scanned
one by one. Without labelled credentials only the base findings are made. Findings that
begin at one place come in the order of the kinds. A text of any length is scanned whole,
in time linear in its length and findings. An empty table gives none. Further columns
of whatever name are not read; ``redact`` returns them as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.automata import Automaton
from tarmac.llm.common import keep, words_of

KINDS = ("assign", "access", "hex", "format")

# The base patterns.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_HINT = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}"

_TOKEN = r"[A-Za-z0-9+/_.=-]{%d,}"
_PLAIN = r"^\p{L}{4,20}[.,;:!?]?$"

#: The labelled sample: so many different values of each kind, none longer than this, and so many ordinary words.
SAMPLE_VALUES, SAMPLE_CHARS, SAMPLE_WORDS = 300, 80, 2000
#: A kind with fewer different values teaches no format.
LEAST_EXAMPLES = 10
#: Verdicts on tokens that a task holds at most, of tokens up to ``SAMPLE_CHARS`` long.
HELD = 200_000
#: Bits per character that a token may be less likely than the least likely example, and must be likelier than as an ordinary word.
SLACK, MARGIN = 0.25, 1.0


def base_findings(text: str) -> list[tuple[int, str, int, str]]:
    """Start, kind, end and value of each base finding, by start and then kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return [(a, KINDS[k], b, v) for a, k, b, v in sorted(found)]


@dataclass
class Formats:
    """Automata of credentials, each with the least likelihood it accepts, that of ordinary words, and the shortest length."""

    credentials: list[tuple[Automaton, float]]
    plain: Automaton | None
    shortest: int = 1
    verdicts: dict[str, bool] = field(default_factory=dict)

    def likely(self, token: str) -> bool:
        if not self.credentials:
            return False
        known = self.verdicts.get(token)
        if known is None:
            known = self._likely(token)
            if len(self.verdicts) > HELD:
                self.verdicts.clear()
            if len(token) <= SAMPLE_CHARS:
                self.verdicts[token] = known
        return known

    def _likely(self, token: str) -> bool:
        plain = self.plain.bits(token) if self.plain else -100.0
        return any((b := a.bits(token)) >= least and b >= plain + MARGIN for a, least in self.credentials)

    def tokens(self, text: str) -> Iterator[re.Match]:
        """The candidates of a text."""
        return re.finditer(_TOKEN % self.shortest, text) if self.credentials else iter(())


def learn(values: dict[str, list[str]], plain: list[str]) -> Formats:
    """Formats from labelled credentials by kind and ordinary words."""
    credentials, lengths = [], []
    for kind in sorted(values):
        examples = sorted(set(values[kind]))
        if len(examples) >= LEAST_EXAMPLES:
            automaton = Automaton(examples)
            credentials.append((automaton, min(map(automaton.bits, examples)) - SLACK))
            lengths += map(len, examples)
    return Formats(credentials, Automaton(sorted(plain)) if plain else None, min(lengths, default=1))


def _joined(spans: list[tuple[int, str, int]]) -> list[list[int]]:
    """First and last place of the stretches that spans, given by their begin, cover."""
    out: list[list[int]] = []
    for a, _, b in spans:
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def findings(text: str | None, formats: Formats) -> list[tuple[int, str, int]]:
    """Start, kind and end of all findings, by start and then kind as listed."""
    text = text or ""
    base = [(a, kind, b) for a, kind, b, _ in base_findings(text)]
    out, taken, k = list(base), _joined(base), 0
    for m in formats.tokens(text):
        # Both lists go by place, so they are walked together.
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if (k == len(taken) or taken[k][0] >= m.end()) and formats.likely(m[0]):
            out.append((m.start(), "format", m.end()))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[1])))


def learn_formats(docs: DataFrame) -> Formats:
    """Formats from a sample of the base findings of all documents, by the order of a hash."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, v) for t in batch.column(0) for _, k, _, v in base_findings(t.as_py()) if len(v) <= SAMPLE_CHARS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.string()) for i in range(2)], ["kind", "value"]
            )

    hinted = docs.filter(F.col("text").rlike(_HINT)).select("text")
    labelled = keep(hinted.mapInArrow(values, "kind string, value string").distinct())
    order = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    sample = labelled.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= SAMPLE_VALUES).collect()
    by_kind: dict[str, list[str]] = {}
    for row in sample:
        by_kind.setdefault(row["kind"], []).append(row["value"])
    word = hinted.select(F.explode(words_of(F.col("text"))).alias("word"))
    word = word.filter(F.col("word").rlike(_PLAIN))
    # A credential of letters is no ordinary word.
    word = word.distinct().join(labelled.select(F.col("value").alias("word")).distinct(), "word", "left_anti")
    plain = word.orderBy(F.xxhash64("word"), "word").limit(SAMPLE_WORDS)
    return learn(by_kind, [r["word"] for r in plain.collect()])


def _listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def secrets(docs: DataFrame) -> DataFrame:
    """Per document the counts of base kinds, the digest of the base findings, all findings and ``n_format``."""
    formats = docs.sparkSession.sparkContext.broadcast(learn_formats(docs))
    names = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format")
    types = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, t in zip(batch.column(0), batch.column(1)):
                spans = findings(t.as_py(), formats.value)
                kinds = [s[1] for s in spans]
                base = _listed([s for s in spans if s[1] != "format"])
                out.append(
                    (i.as_py(), *(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(base.encode()).hexdigest(), _listed(spans), kinds.count("format"))
                )
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(types)], names)

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_format bigint"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(scan, schema)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with each finding replaced by its kind in brackets; ``n_chars``, if there, follows the text."""
    formats = docs.sparkSession.sparkContext.broadcast(learn_formats(docs))

    def clean(text: str | None) -> str | None:
        out, at = [], 0
        for a, kind, b in findings(text, formats.value):
            if b > at:
                out += [text[at : max(a, at)], f"[{kind}]" if a >= at else ""]
                at = b
        return "".join([*out, text[at:]]) if out else text

    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            texts = [clean(t.as_py()) for t in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            k = names.index("n_chars") if "n_chars" in names else -1
            if k >= 0 and pa.types.is_integer(batch.schema.field(k).type):
                sizes = [n.as_py() if t == old.as_py() else len(t) for n, t, old in zip(batch.column(k), texts, batch.column(at))]
                columns[k] = pa.array(sizes, batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    # By place, as mapInArrow takes a dot in a name for a field.
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    return plain.mapInArrow(run, plain.schema).toDF(*names)
