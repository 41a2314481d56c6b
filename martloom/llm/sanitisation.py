"""Personal data by pattern, and the terms that would give it away.

Protected entities are the addresses and numbers found by pattern. How much a term reveals of an
entity is estimated over the corpus: with N texts, the entity in n_c, the term in n_t, and both in
n_ct of them, the chance of the entity in a text with the term is estimated as

    p = (n_ct + n_c / N) / (n_t + 1)

(one text of the corpus' average is added, so that one meeting proves less than many). The term
tells log2(p * N / n_c) of the entity's log2(N / n_c) bits. It is treated if this share is large
and p is at least ``certainty``: a term that as many texts hold without the entity points nowhere.
Such terms are generalised or removed in every text that holds them. Texts count once, however many
copies there are.

Entities that stand in the same texts meet every term equally often, so they are counted as one
class, and a text's terms are met with its classes, not with each of its entities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.llm.common import framed, sliced, small_side, stored, unframed, whole_text

# The patterns and their order.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Runs of letters, the same class in Python and in Java.
_TERM = re.compile(r"[^\x00-@\[-`{-\u00bf\u2000-\u206f\u3000-\u303f]+")
_BETWEEN = r"[\x00-@\[-`{-\u00bf\u2000-\u206f\u3000-\u303f]+"

Span = tuple[str, int, int]
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Disclosure:
    """Terms that tell ``generalise`` of an entity's bits are generalised, ``remove`` removed, if the
    entity's chance beside them is ``certainty``. Up to ``broadcast_terms`` hashes of 8 bytes and
    ``broadcast_bytes`` of treated terms are sent to all executors; beyond, Spark shuffles."""

    generalise: float = 0.6
    remove: float = 0.8
    certainty: float = 0.5
    broadcast_terms: int = 2_000_000
    broadcast_bytes: int = 8_000_000


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in _NUMBERS.finditer(text):
        parts, at = run.group().split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            start = at + sum(len(p) + 1 for p in parts[:k]) if k else at
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                yield start, end


def _luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans by pattern, by kind and then start."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return found
    found += [("ip", a, b) for a, b in _addresses(text)]
    for match in _CARD.finditer(text):
        if len(match.group()) >= 16:
            digits = _only_digits(match.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= len(_only_digits(match.group())) <= 15:
                found.append(("phone", *match.span()))
    return found


def entity_terms(text: str, spans: list[Span]) -> tuple[list[str], list[str]]:
    """The different entities of a text, and its different terms outside of them."""
    places, k, terms = sorted((a, b) for _, a, b in spans), 0, set()
    for match in _TERM.finditer(text):
        while k < len(places) and places[k][1] <= match.start():
            k += 1
        if k == len(places) or match.end() <= places[k][0]:
            terms.add(match.group())
    entities = set()
    for kind, a, b in spans:
        value = text[a:b].lower() if kind in ("email", "ip") else _only_digits(text[a:b])
        entities.add(f"{kind}:{value}")
    return sorted(entities), sorted(terms)


def _entity_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    strings = pa.list_(pa.string())
    for batch in sliced(batches):
        hashes, entities, terms = [], [], []
        for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            spans = base_spans(text)
            if spans:
                named, held = entity_terms(text, spans)
                hashes.append(key)
                entities.append(named)
                terms.append(held)
        columns = [pa.array(hashes, pa.int64()), pa.array(entities, strings), pa.array(terms, strings)]
        yield pa.RecordBatch.from_arrays(columns, ["text_hash", "entities", "terms"])


def copy_counts(texts: DataFrame) -> DataFrame:
    """text_hash, copies of the texts that occur more than once."""
    counts = texts.groupBy("text_hash").agg(F.count("*").alias("copies"))
    return stored(counts.where("copies > 1"))


def _words(texts: DataFrame, *kept: str) -> DataFrame:
    """term (hash of the small word) once for each text row and word."""
    words = F.array_distinct(F.transform(F.split("_text", _BETWEEN), F.lower))
    rows = texts.select(F.explode(words).alias("word"), *kept)
    return rows.select(F.xxhash64("word").alias("term"), "word", *kept)


def term_counts(
    texts: DataFrame, copies: DataFrame, wanted: DataFrame, how: Disclosure
) -> DataFrame:
    """term, n_t: how many different texts hold each wanted term; every text is read whole.

    A copy counts as the part that it is of all copies, so that rows can be summed where they
    arise and only sums are shuffled.
    """
    weighed = texts.join(small_side(copies, how.broadcast_terms), "text_hash", "left")
    rows = _words(weighed, "copies").select(
        "term", (1 / F.coalesce("copies", F.lit(1))).alias("part")
    )
    total = F.round(F.sum("part")).alias("n_t")
    if wanted.count() <= how.broadcast_terms:
        return rows.join(F.broadcast(wanted), "term").groupBy("term").agg(total)
    # Too many for every executor: summed first, so that a common word is one row of each task.
    return rows.groupBy("term").agg(total).join(wanted, "term")


def entity_classes(mentions: DataFrame) -> DataFrame:
    """text_hash, class, n_c: entities that stand in the same texts are one class."""
    mark = F.sum(F.xxhash64("text_hash").cast("decimal(38,0)")).cast("string")
    by_entity = mentions.groupBy("entity").agg(F.count("*").alias("n_c"), mark.alias("mark"))
    named = by_entity.select("entity", "n_c", F.xxhash64("n_c", "mark").alias("class"))
    return mentions.join(named, "entity").select("text_hash", "class", "n_c").distinct()


def disclosing_terms(docs: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """term, word, share: the terms to treat and the largest share of an entity's bits each tells."""
    texts = docs.select(F.xxhash64(docs["text"]).alias("text_hash"), whole_text().alias("_text"))
    copies = copy_counts(texts)
    more = copies.agg(F.sum(F.col("copies") - 1)).first()[0] or 0
    n = float(texts.count() - more)
    found = stored(
        texts.mapInArrow(_entity_texts, "text_hash long, entities array<string>, terms array<string>")
    )
    mentions = found.select("text_hash", F.explode("entities").alias("entity")).distinct()
    classes = stored(entity_classes(mentions))
    held = found.select("text_hash", F.explode("terms").alias("word"))
    held = stored(held.select("text_hash", F.lower("word").alias("word")).distinct())
    # A term stands in at least as many texts as entity texts hold it: common words are out before
    # all texts are searched.
    at_least = held.groupBy("word").agg(F.count("*").alias("at_least"))
    met = held.join(classes, "text_hash").groupBy("class", "n_c", "word").agg(F.count("*").alias("n_ct"))
    best = F.col("n_ct") + F.col("n_c") / F.lit(n)
    pairs = met.join(at_least, "word").where(best >= how.certainty * (F.col("at_least") + 1))
    pairs = pairs.select(F.xxhash64("word").alias("term"), "word", "n_c", "n_ct")
    # Classes with the same counts say the same of a term.
    pairs = stored(pairs.distinct())
    counts = term_counts(texts, copies, stored(pairs.select("term").distinct()), how)
    p = best / (F.col("n_t") + 1)
    bits, told = F.log2(F.lit(n) / F.col("n_c")), F.log2(p * F.lit(n) / F.col("n_c"))
    shares = pairs.join(counts, "term").select(
        "term", "word", p.alias("p"), F.when(bits > 0, told / bits).otherwise(0.0).alias("share")
    )
    telling = shares.where((F.col("p") >= how.certainty) & (F.col("share") >= how.generalise))
    return telling.groupBy("term", "word").agg(F.max("share").alias("share"))


def terms_of_texts(docs: DataFrame, telling: DataFrame, how: Disclosure) -> DataFrame:
    """text_hash, removed, generalised: the treated words of every text that holds any."""
    texts = docs.select(F.xxhash64(docs["text"]).alias("text_hash"), whole_text().alias("_text"))
    side = telling.select("term", (F.col("share") >= how.remove).alias("remove"))
    rows = _words(texts, "text_hash").join(small_side(side, how.broadcast_terms), "term")

    def words(wanted: Column) -> Column:
        return F.sort_array(F.collect_set(F.when(wanted, F.col("word"))))

    return rows.groupBy("text_hash").agg(
        words(F.col("remove")).alias("removed"), words(~F.col("remove")).alias("generalised")
    )


def term_spans(
    text: str, base: list[Span], removed: frozenset[str], generalised: frozenset[str]
) -> list[Span]:
    """Spans of the terms outside of the base spans, generalised ones first."""
    places, k, found = sorted((a, b) for _, a, b in base), 0, []
    for match in _TERM.finditer(text):
        word = match.group().lower()
        kind = "removed" if word in removed else "generalised" if word in generalised else None
        if kind is None:
            continue
        while k < len(places) and places[k][1] <= match.start():
            k += 1
        if k == len(places) or match.end() <= places[k][0]:
            found.append((kind, *match.span()))
    return sorted(found)


def cleaned(text: str, spans: list[Span]) -> str:
    """The text with entities as their kind, generalised terms as [name] or [term], others gone.

    Of overlapping spans the first gives the replacement and the cut runs to the end of the last.
    """
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start < at:
            at = max(at, end)
            continue
        out.append(text[at:start])
        if kind == "generalised":
            out.append("[name]" if text[start].isupper() else "[term]")
        elif kind != "removed":
            out.append(f"[{kind}]")
        at = end
    out.append(text[at:])
    return "".join(out)


def _span_array(found: list[list[Span]]) -> pa.Array:
    """Lists of spans column by column, without an object for each span."""
    ends = [0, *accumulate(map(len, found))]
    flat = list(chain.from_iterable(found))
    kinds, starts, stops = zip(*flat, strict=True) if flat else ((), (), ())
    fields = [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())]
    spans = pa.StructArray.from_arrays(fields, ["kind", "start", "end"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    added = ["in_text", "_removed", "_generalised"]
    for batch in sliced(batches):
        spans, texts = [], []
        for text, removed, generalised in zip(
            *(batch.column(c).to_pylist() for c in added), strict=True
        ):
            found = base_spans(text or "")
            if removed or generalised:
                found += term_spans(
                    text or "", found, frozenset(removed or ()), frozenset(generalised or ())
                )
            spans.append(found)
            texts.append(cleaned(text, found) if found else text)
        kept = batch.drop_columns(added).append_column("spans", _span_array(spans))
        yield kept.append_column("clean_text", pa.array(texts, pa.string()))


def sanitised(docs: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """Every row of ``docs`` (columns prefixed ``in_``, without the text), then spans and clean_text.

    spans holds (kind, start, end) in code points: email, ip, card, phone, generalised, removed,
    each by start. A null text has no spans and stays null; repeated rows stay; texts without
    entities and without telling terms are left as they are; an empty table gives an empty one.
    The corpus is counted while the query is built; what it finds is stored in the shared folder.
    """
    telling = stored(disclosing_terms(docs, how))
    words = stored(terms_of_texts(docs, telling, how))
    size = F.size("removed") + F.size("generalised")
    # Words take some 20 bytes each in memory, and a text's row some 100.
    weight = words.agg(F.sum(size * 20 + 100)).first()[0] or 0
    side = words.select(
        F.col("text_hash").alias("_of"),
        F.col("removed").alias("_removed"),
        F.col("generalised").alias("_generalised"),
    )
    side = F.broadcast(side) if weight <= how.broadcast_bytes else side
    hashed = framed(docs).withColumn("_hash", F.xxhash64("in_text"))
    rows = hashed.join(side, F.col("_hash") == F.col("_of"), "left").drop("_hash", "_of")
    given = ("in_text", "_removed", "_generalised")
    schema = StructType([f for f in rows.schema.fields if f.name not in given])
    schema = schema.add("spans", StructType.fromDDL(f"s {SPANS}")["s"].dataType)
    return rows.mapInArrow(_apply, schema.add("clean_text", "string"))


def without_personal_data(docs: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """The documents with cleaned texts, and ``n_chars`` counted anew if there."""
    done = sanitised(docs, how)
    return unframed(
        done, docs, text=F.col("clean_text"), n_chars=F.length("clean_text").cast("long")
    )
