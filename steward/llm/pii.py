"""Personal data: patterns, and terms that reveal it (operator 8).

E-mail addresses, IP addresses, card and phone numbers are found by pattern; each distinct value is a protected entity, and so
is the domain of an address, which pools what its addresses have in common. Words that stand near a mention of an entity
somewhere are judged by the corpus. With ``n_e`` documents that mention the entity, ``n_t`` that hold the term, and ``n_et``
that do both, the term anywhere in the text, out of ``N``, and with the number of different contexts in which the term stands
near the entity, a term reveals the entity if both hold:

* Information. The disclosure, ``1 + log(n_et / n_t) / log(N / n_e)``, is the pointwise mutual information as a share of the entity's
  information: 1 for a term that is seen with the entity only, about 0 for a common one. ``n_et / n_t`` is drawn towards
  ``n_e / N`` as by one more context. It must reach the threshold.
* Evidence. The lower confidence bound (Wilson's, one-sided 95 %) of ``n_et / n_t``, the contexts being the sample, exceeds one half: the
  term points at the entity more often than not, and not by chance. What was seen once is no evidence, in a table of any size;
  without counterexamples three contexts are.

Where such terms stand outside the patterns' spans, in any document, they are spans as well, to be generalised or removed.

Texts are read three times: for mentions, for ``n_t`` of the words near them, and for the places of the words whose ``n_t``
lets them pass. Pairs that could not have the evidence if every document of the rarer of both held both are dropped before each
of the last two. Words are told to the tasks as a bit map of fixed size, and joins drop what it lets through by chance. Mentions,
terms and places stay in tables. Rows are known by two 64-bit hashes of id and text.

Defined results: a null text counts as empty and has no spans; repeated rows have the same spans and count once each; contexts
(the words around a mention) that are equal, as in copies, count once; a null id is kept; very long texts are read whole; an
empty table gives an empty result; other columns are carried along by :func:`sanitised` whatever their names.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf
from pyspark.sql.pandas.types import to_arrow_schema

from steward.llm.columns import aside, picked, quoted
from steward.session import stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

#: Words to either side of a mention that are near it and its context.
WINDOW = 5
#: The normal quantile of the evidence, and the rate that it must show.
CONFIDENCE, LIKELY = 1.645, 0.5
#: Disclosure from which a term is a span.
DISCLOSED = 0.9
#: Bits of the map of terms to count; more terms than fit only make more words be counted.
MAP_BITS = 1 << 23
#: Distinct terms a worker counts before it passes them on.
COUNTED_AT_ONCE = 400_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGIT = re.compile(r"[0-9]")
# Where a match starts inside a run of digits it would start earlier, so runs need to be tried from their start only.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_][\w'-]*")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, ``@`` and a domain with a dot. A local part is the whole run of its characters before
    the ``@``, so each ``@`` is looked at once, and long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", max(at + 1, done))


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def luhn(digits: str) -> bool:
    """Whether the check digit of a number is right."""
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    ordered = [ord(d) - 48 for d in reversed(digits)]
    return (sum(ordered[::2]) + sum(doubled[d] for d in ordered[1::2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns that pass their checks, by kind and start; ends are exclusive, in code points."""
    found: list[Span] = [("email", a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return found
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 16:
            continue
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts)) - (1 << 63)


def free_words(text: str, spans: list[Span]) -> list[tuple[int, int, str]]:
    """``(start, end, word)`` of the words that touch no span, in order and in small letters."""
    taken = sorted((start, end) for _, start, end in spans)
    starts = [s for s, _ in taken]
    reach = list(np.maximum.accumulate([e for _, e in taken])) if taken else []
    words = []
    for m in _WORD.finditer(text):
        before = bisect.bisect_left(starts, m.end()) - 1
        if before < 0 or reach[before] <= m.start():
            words.append((m.start(), m.end(), m[0].lower()))
    return words


def _entities(text: str, span: Span) -> list[int]:
    """A mention's value and, of an address, its domain."""
    kind, start, end = span
    value = text[start:end].lower()
    return [_hash(kind, value), *([_hash("domain", value.rpartition("@")[2])] if kind == "email" else [])]


def near_words(text: str, spans: list[Span], window: int) -> set[tuple[int, int, str]]:
    """``(entity, context, term)`` for the words around each mention."""
    if not spans:
        return set()
    words = free_words(text, spans)
    at = [w[0] for w in words]
    out = set()
    for span in spans:
        left, right = bisect.bisect_left(at, span[1]), bisect.bisect_left(at, span[2])
        around = [w for _, _, w in words[max(0, left - window) : left] + words[right : right + window]]
        context = _hash(*around)
        out.update((entity, context, w) for entity in _entities(text, span) for w in around)
    return out


MENTIONS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("row_key", T.StringType()),
        *[T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS],
        T.StructField("base_spans", T.StringType()),
        T.StructField("entities", T.ArrayType(T.LongType())),
        T.StructField("near", T.ArrayType(T.StructType(
            [T.StructField("entity", T.LongType()), T.StructField("context", T.LongType()), T.StructField("term", T.StringType())]
        ))),
    ]
)


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits of a row's id and text, as text: rows that share it are equal."""
    return F.concat_ws(":", F.hex(F.xxhash64(doc_id, text)), F.hex(F.xxhash64(F.lit("second"), text, doc_id)))


def mentions(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: counts and spans of the patterns, entities, and the words near them."""
    schema = to_arrow_schema(MENTIONS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, key, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "row_key", "text")), strict=True):
                spans = base_spans(text or "")
                n = Counter(kind for kind, _, _ in spans)
                near = [{"entity": e, "context": c, "term": w} for e, c, w in sorted(near_words(text or "", spans, window))]
                entities = sorted({e for span in spans for e in _entities(text, span)})
                out.append((doc, key, *(n[k] for k in KINDS), listed(spans), entities, near))
            if out:
                columns = zip(*out, strict=True)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)

    keyed = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("row_key"))
    return keyed.mapInArrow(find, MENTIONS)


#: A document's terms and all places of each.
PLACES = T.StructType(
    [
        T.StructField("row_key", T.StringType()), T.StructField("term", T.StringType()),
        T.StructField("places", T.ArrayType(T.StructType(
            [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
        ))),
    ]
)


def _bit_map(terms: DataFrame) -> np.ndarray:
    """A map with the bit of each term set: ``MAP_BITS / 64`` numbers at most come to the driver."""
    bit = F.pmod(F.xxhash64("term"), F.lit(MAP_BITS))
    at = terms.select((bit / 64).cast("int").alias("i"), F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(term), {MAP_BITS}) % 64 AS INT))").alias("b"))
    rows = at.groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(MAP_BITS // 64, dtype=np.int64)
    out[rows["i"].to_numpy()] = rows["b"].to_numpy()
    return out


def _in_map(term: str, bits: np.ndarray) -> bool:
    bit = (xxhash.xxh64_intdigest(term.encode(), seed=42)) % MAP_BITS
    return bool((int(bits[bit >> 6]) >> (bit & 63)) & 1)


def document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, n_t)``: the number of rows of ``docs(text)`` that hold each term of ``terms``."""
    bits = _bit_map(terms)
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    schema = "term string, n long"
    if not bits.any():
        return docs.sparkSession.createDataFrame([], "term string, n_t long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        wanted: dict[str, bool] = {}

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["term", "n"])
            seen.clear()
            return batch

        for batch in batches:
            for text in batch["text"].to_pylist():
                for word in {w.lower() for w in set(_WORD.findall(text or ""))}:
                    take = wanted.get(word)
                    if take is None:
                        if len(wanted) > COUNTED_AT_ONCE:
                            wanted.clear()
                        take = wanted[word] = _in_map(word, sent.value)
                    if take:
                        seen[word] += 1
                if len(seen) > COUNTED_AT_ONCE:
                    yield out()
        yield out()

    counted = docs.select("text").mapInArrow(count, schema).groupBy("term").agg(F.sum("n").alias("n_t"))
    return counted.join(terms, "term", "left_semi")


def term_places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(row_key, term, places)``: where rows of ``docs(doc_id, text)`` hold ``terms``, outside the spans of patterns."""
    bits = _bit_map(terms)
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    schema = to_arrow_schema(PLACES)
    if not bits.any():
        return docs.sparkSession.createDataFrame([], PLACES)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[str, bool] = {}

        def take(word: str) -> bool:
            known = wanted.get(word)
            if known is None:
                if len(wanted) > COUNTED_AT_ONCE:
                    wanted.clear()
                known = wanted[word] = _in_map(word.lower(), sent.value)
            return known

        for batch in batches:
            out = []
            for key, text in zip(batch["row_key"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if not text or not any(map(take, set(_WORD.findall(text)))):
                    continue
                words = free_words(text, base_spans(text))
                found: dict[str, list[int]] = {}
                for i, (_, _, word) in enumerate(words):
                    if take(word):
                        found.setdefault(word, []).append(i)
                for word, at in found.items():
                    out.append((key, word, [{"start": words[i][0], "end": words[i][1]} for i in at]))
            if out:
                columns = zip(*out, strict=True)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)

    keyed = docs.select("text", row_key(F.col("doc_id"), F.col("text")).alias("row_key"))
    return keyed.mapInArrow(find, PLACES).join(terms, "term", "left_semi")


def disclosure(n: int, n_e: Column, n_t: Column, n_et: Column, contexts: Column) -> Column:
    """The share of an entity's information that a term gives; null for an entity of every document. The rate ``n_et / n_t``
    is weighed by the different contexts it was seen in against one seen at the entity's own rate."""
    own = n_e / F.lit(float(n))
    rate = (n_et / n_t * contexts + own) / (contexts + 1)
    return F.when(n_e < n, 1 - F.log(rate) / F.log(own))


def evidence(n_t: Column, n_et: Column, contexts: Column) -> Column:
    """The lower confidence bound of ``n_et / n_t``, where the hits are as many as ``contexts`` and the misses in proportion."""
    rate = n_et / n_t
    sample, z2 = contexts / rate, CONFIDENCE**2
    spread = F.sqrt(rate * (1 - rate) / sample + z2 / (4 * sample * sample))
    return (rate + z2 / (2 * sample) - CONFIDENCE * spread) / (1 + z2 / sample)


def reveals(n: int, n_e: Column, n_t: Column, n_et: Column, contexts: Column, disclosed: float) -> Column:
    """Whether a term with these counts gives the entity away."""
    return (disclosure(n, n_e, n_t, n_et, contexts) >= disclosed) & (evidence(n_t, n_et, contexts) > LIKELY)


def candidate_pairs(found: DataFrame) -> DataFrame:
    """``(entity, term, contexts, n_e)`` of the pairs that have the evidence if all documents of the term mention the entity.
    ``found`` is what :func:`mentions` gives."""
    near = found.select(F.inline("near")).distinct()
    pairs = near.groupBy("entity", "term").agg(F.count("*").alias("contexts"))
    n_e = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    enough = evidence(F.lit(1.0), F.lit(1.0), F.col("contexts")) > LIKELY
    return pairs.filter(enough).join(n_e, "entity")


def revealing_terms(docs: DataFrame, found: DataFrame, disclosed: float = DISCLOSED) -> tuple[DataFrame, DataFrame]:
    """``(entity, term, disclosure)`` of the terms that give entities away, and the places of all terms that could. ``found`` is
    what :func:`mentions` gives of ``docs``."""
    pairs = stored(candidate_pairs(found), "pii-candidates")
    n = found.count()
    n_t = document_counts(docs, pairs.select("term").distinct())
    # A pair cannot disclose more than if all documents of the rarer of both held both; the rest is slack for rounding.
    most = F.least("n_e", "n_t").cast("double")
    able = (disclosure(n, F.col("n_e"), F.col("n_t"), most, F.col("contexts")) >= disclosed - 1e-9) & (
        evidence(F.col("n_t"), most, F.col("contexts")) > LIKELY - 1e-9
    )
    able = stored(pairs.join(n_t, "term").filter(able), "pii-able")
    places = stored(term_places(docs, able.select("term").distinct()), "pii-places")
    mentioned = found.select("row_key", F.explode("entities").alias("entity")).distinct()
    both = places.select("row_key", "term").join(able.select("entity", "term"), "term").join(mentioned, ["row_key", "entity"], "left_semi")
    n_et = both.groupBy("entity", "term").agg(F.count("*").alias("n_et"))
    counts = [F.col(c) for c in ("n_e", "n_t", "n_et", "contexts")]
    judged = able.join(n_et, ["entity", "term"]).filter(reveals(n, *counts, disclosed))
    return judged.select("entity", "term", disclosure(n, *counts).alias("disclosure")), places


def term_spans(revealing: DataFrame, places: DataFrame) -> DataFrame:
    """``(row_key, terms)``: for rows with revealing terms, all their ``(start, end)`` in order."""
    hits = places.join(revealing.select("term").distinct(), "term", "left_semi").select("row_key", F.inline("places"))
    return hits.groupBy("row_key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("terms"))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_email, n_ip, n_card, n_phone, base_spans, terms``; ``terms`` are the spans that
    the corpus adds, null for none."""
    rows = picked(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = stored(mentions(rows), "pii-mentions")
    added = term_spans(*revealing_terms(rows, found))
    return found.drop("entities", "near").join(added, "row_key", "left").drop("row_key")


def masked(text: str | None, terms, action: str) -> str | None:
    """``text`` with each base span replaced by its kind and each term generalised or removed; overlapping spans of patterns
    become one, with the first's kind."""
    if text is None:
        return None
    spans = [(start, end, f"[{kind.upper()}]") for kind, start, end in base_spans(text)]
    spans += [(start, end, "" if action == "remove" else "[TERM]") for start, end in terms]
    out, at = [], 0
    for start, end, sign in sorted(spans):
        if start < at:
            at = max(at, end)
            continue
        out += [text[at:start], sign]
        at = end
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", action: str = "generalise") -> DataFrame:
    """``docs`` with personal data masked in ``text``, all other columns as they are. ``action`` for revealing terms is
    ``generalise`` or ``remove``."""
    if action not in ("generalise", "remove"):
        raise ValueError(f"unknown action {action}")
    rows = picked(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = stored(mentions(rows), "pii-mentions")
    added = stored(term_spans(*revealing_terms(rows, found)), "pii-terms")

    @pandas_udf("string")
    def mask(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series(
            [masked(t, () if a is None else zip(a, b, strict=True), action) for t, a, b in zip(texts, starts, ends, strict=True)],
            dtype=object,
        )

    key, terms = aside(docs.columns, "_row_key", "_terms")
    keyed = docs.withColumn(key, row_key(quoted(doc_id).cast("long"), quoted(text)))
    joined = keyed.join(added.select(F.col("row_key").alias(key), F.col("terms").alias(terms)), key, "left")
    out = joined.withColumn(text, mask(quoted(text), F.col(terms)["start"], F.col(terms)["end"]))
    return out.select(*[quoted(c) for c in docs.columns])


