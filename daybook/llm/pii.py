"""Information-theoretic sanitisation of personal data.

Protected entities are e-mail addresses, IP addresses, card numbers and phone
numbers, found by pattern and checked (octets, Luhn, digit counts). They are
then used to judge the words around them over the whole corpus. With N
documents, d(e) of them holding the entity e, d(t) holding the term t and
d(e, t) holding t within ``window`` characters of e:

    information of e      IC(e)     = log2(N / d(e))
    what t tells about e  PMI(e, t) = log2(N d(e, t) / (d(e) d(t)))
    disclosure            PMI / IC, 1 if t alone gives e away

A term that occurs near e in at least ``support`` documents and whose disclosure
reaches ``generalise`` becomes a general word wherever it stands in a document
that holds e. From ``remove`` on it gives e away alone and goes from every
document of the corpus. Entities themselves are always replaced.

A text's matches and the pieces between them have the same order, so positions
are running sums of their lengths. Pairs are made distinct within a document and
summed before the shuffle; a frequent entity is one row for each term near it.
DataFrame functions only.

Defined cases: null texts are empty; a match that fails its check is dropped and
its characters are not searched again for that kind; repeated rows count as
documents of their own and get the same spans; rows with a null id are treated
like any other; an empty table gives an empty result; other columns are ignored
(and pass unchanged through ``sanitise``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize
from .decontaminate import _once

#: Possessive forms of the patterns: the same matches, without backtracking and
#: without a second look at a long run of characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without this character has no match.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
KINDS = [*PATTERNS, "generalised", "removed"]
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalised": "[TERM]", "removed": ""}

#: Words of three letters or more that aren't part of an address, a name with digits or the like.
TERM = r"(?<![\p{L}\p{N}@._%+-])\p{L}{3,}+(?!\.?[\p{L}\p{N}@_%+-])"
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9])?"
_BLOCK = 64


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, x: total + x)


def _starts(pieces: Column, matches: Column) -> Column:
    """Start of each match: the lengths of all pieces and matches before it.

    Sums of blocks first, so that a text with many matches isn't summed from its
    start for each.
    """

    def blocks(s: Column) -> Column:
        count = F.floor((F.size(s["step"]) + (_BLOCK - 1)) / _BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), count - 1), lambda b: _sum(F.slice(s["step"], b * _BLOCK + 1, F.lit(_BLOCK))))
        before = lambda all_sums: F.transform(F.sequence(F.lit(0), F.size(all_sums) - 1), lambda b: _sum(F.slice(all_sums, F.lit(1), b)))
        return _once(_once(sums, before), lambda base: places(s, base))

    def places(s: Column, base: Column) -> Column:
        def at(i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            return F.get(base, block) + _sum(F.slice(s["step"], block * _BLOCK + 1, i - block * _BLOCK)) + F.get(s["lengths"], i)

        return F.transform(F.sequence(F.lit(0), F.size(s["step"]) - 1), at)

    lengths = F.transform(pieces, lambda p: F.length(p))
    step = F.zip_with(F.slice(lengths, F.lit(1), F.size(matches)), matches, lambda n, m: n + F.length(m))
    return _once(F.struct(lengths.alias("lengths"), step.alias("step")), blocks)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")
    if kind == "card":
        return F.when(F.length(_digits(value)).between(12, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _part(at: Column, length: Column, block: int) -> Column:
    """``length`` characters of the text from place ``at`` on, of column ``blocks``: no long text is walked for each match."""
    first = F.floor(at / block).cast("int")
    two = F.concat(*[F.coalesce(F.get("blocks", first + k), F.lit("")) for k in (0, 1)])
    return F.substring(two, at - first * block + 1, length)


def _spans(kind: str, window: int, block: int) -> Column:
    """Valid matches of a kind in columns m_kind and p_kind: start, kind, end, value and the text on both sides.

    Both sides are taken from the whole text, other matches included, with what
    ``TERM`` looks at beyond the window (one character before, two after).
    """
    m, p, number = F.col(f"m_{kind}"), F.col(f"p_{kind}"), KINDS.index(kind)

    def all_spans(starts: Column) -> Column:
        def one(value: Column, i: Column) -> Column:
            start = F.get(starts, i)
            return F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + F.length(value)).alias("end"), value.alias("value"))

        def sides(s: Column) -> Column:
            before = F.greatest(s["start"] - window - 1, F.lit(0))
            return F.struct(
                s["start"], s["kind"], s["end"], s["value"],
                _part(before, s["start"] - before, block).alias("left"), _part(s["end"], F.lit(window + 2), block).alias("right"),
            )

        return F.transform(F.filter(F.transform(m, one), lambda s: _valid(kind, s["value"])), sides)

    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string,left:string,right:string>>")
    return F.when(F.size(m) > 0, _once(_starts(p, m), all_spans)).otherwise(none)


def _terms(text: Column) -> Column:
    """The terms of a text: (term, start, end)."""
    matches = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    pieces = F.split(text, TERM, -1)
    found = lambda m: F.transform(
        F.arrays_zip(m.alias("m"), _starts(pieces, m).alias("at")),
        lambda x: F.struct(F.lower(x["m"]).alias("term"), x["at"].alias("start"), (x["at"] + F.length(x["m"])).alias("end")),
    )
    none = F.array().cast("array<struct<term:string,start:int,end:int>>")
    return _once(matches, lambda m: F.when(F.size(m) > 0, found(m)).otherwise(none))


def _near(span: Column, window: int) -> Column:
    """Terms beside an entity, whole within the window: (entity, term, start, end)."""
    entity = F.concat_ws(":", span["kind"], F.lower(span["value"]))

    def side(text: Column, base: Column) -> Column:
        return F.transform(
            _terms(text), lambda x: F.struct(entity.alias("entity"), x["term"], (base + x["start"]).alias("start"), (base + x["end"]).alias("end"))
        )

    both = F.concat(side(span["left"], span["start"] - F.length(span["left"])), side(span["right"], span["end"]))
    return F.filter(both, lambda x: (x["start"] >= span["start"] - window) & (x["end"] <= span["end"] + window))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("mark", F.xxhash64("text"))


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 64) -> DataFrame:
    """(doc, mark, spans, near) for every row: valid matches in order, and the terms around them."""
    rows = _rows(docs, id_col, text_col)
    none = F.array().cast("array<string>")

    def matches(kind: str) -> Column:
        found = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))
        return F.when(F.contains("text", F.lit(NEEDS[kind])), found).otherwise(none) if kind in NEEDS else found

    rows = rows.select("doc", "mark", "text", *[matches(k).alias(f"m_{k}") for k in PATTERNS])
    pieces = [F.when(F.size(f"m_{k}") > 0, F.split("text", PATTERNS[k], -1)).otherwise(none).alias(f"p_{k}") for k in PATTERNS]
    block = max(256, window + 2)
    matched = F.greatest(*[F.size(f"m_{k}") for k in PATTERNS]) > 0
    blocks = F.when(matched, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block}}}+"), F.lit(0))).otherwise(none)
    rows = rows.select("doc", "mark", *[f"m_{k}" for k in PATTERNS], *pieces, blocks.alias("blocks"))
    rows = rows.select("doc", "mark", F.array_sort(F.concat(*[_spans(k, window, block) for k in PATTERNS])).alias("spans"))
    near = F.array_distinct(F.flatten(F.transform("spans", lambda s: _near(s, window))))
    return rows.select("doc", "mark", F.transform("spans", lambda s: s.dropFields("left", "right")).alias("spans"), near.alias("near"))


def _named() -> Column:
    return F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))))


def disclosing(
    docs: DataFrame, found: DataFrame, text_col: str = "text", support: int = 3, generalise: float = 0.6, remove: float = 0.9
) -> DataFrame:
    """(entity, term, disclosure, kind) of the pairs that reach a threshold."""
    total = found.count()
    # within a document once, so that documents are counted
    pairs = found.select(F.explode(F.array_distinct(F.transform("near", lambda n: F.struct(n["entity"], n["term"])))).alias("p"))
    joint = pairs.groupBy("p.entity", "p.term").agg(F.count("*").alias("joint")).where(F.col("joint") >= support)
    joint = materialize(joint, "joint")
    holders = found.select(F.explode(_named()).alias("entity")).groupBy("entity").agg(F.count("*").alias("holders"))
    # every term's documents: the words of a corpus are summed like any word count
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TERM), F.lit(0)))
    seen = docs.where(F.col(text_col).isNotNull()).select(F.explode(words).alias("term"))
    seen = seen.groupBy("term").agg(F.count("*").alias("seen")).where(F.col("seen") >= support)
    counted = joint.join(materialize(holders.where(F.col("holders") >= support), "holders"), "entity").join(materialize(seen, "seen"), "term")
    information = F.log2(total / F.col("holders"))
    told = F.log2(total * F.col("joint") / (F.col("holders") * F.col("seen")))
    rated = counted.where(F.col("holders") < total).select("entity", "term", (told / information).alias("disclosure"))
    kind = F.when(F.col("disclosure") >= remove - 1e-9, KINDS.index("removed")).otherwise(KINDS.index("generalised"))
    return rated.where(F.col("disclosure") >= generalise - 1e-9).withColumn("kind", kind)


def _everywhere(docs: DataFrame, found: DataFrame, told: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, mark, start, end, kind) of all places of disclosing terms: removed ones in any row, others where their entity is.

    Whether a document holds an entity that a general term tells of is asked from
    the side that has fewer: the entities of the document, or those of the term.
    So a term of many entities, or a document of many, multiplies nothing by them.
    """
    rows = _rows(docs, id_col, text_col)
    words = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), lambda w: F.lower(w)))
    kinds = told.groupBy("term").agg(F.max("kind").alias("kind"), F.count("*").alias("told_of"))
    # only words that tell something of some entity go on
    hits = materialize(rows.select("doc", "mark", F.explode(words).alias("term")).join(kinds, "term"), "hits")
    removed = F.col("kind") == KINDS.index("removed")
    same = F.col("doc").eqNullSafe(F.col("tdoc")) & (F.col("mark") == F.col("tmark"))
    holders = found.where(F.size("spans") > 0).select(F.col("doc").alias("tdoc"), F.col("mark").alias("tmark"), _named().alias("named"))
    held = holders.select("tdoc", "tmark", F.explode("named").alias("tentity")).distinct()
    count = holders.select("tdoc", "tmark", F.size("named").alias("holds")).distinct()
    general = materialize(hits.where(~removed).join(count, same).select("doc", "mark", "term", "kind", "told_of", "holds"), "general")
    pairs = told.select("term", "entity")
    few = general.where(F.col("holds") <= F.col("told_of")).join(held, same).withColumn("entity", F.col("tentity"))
    few = few.select("doc", "mark", "term", "kind", "entity").join(pairs, ["term", "entity"], "left_semi")
    many = general.where(F.col("holds") > F.col("told_of")).join(pairs, "term")
    many = many.join(held, same & (F.col("entity") == F.col("tentity")), "left_semi")
    hits = hits.select("doc", "mark", "term", "kind")
    beside = few.select(*hits.columns).unionByName(many.select(*hits.columns))
    hits = hits.where(removed).unionByName(beside).groupBy("doc", "mark").agg(F.collect_set(F.struct("term", "kind")).alias("kinds"))
    hits = materialize(hits, "told").select(F.col("doc").alias("tdoc"), F.col("mark").alias("tmark"), F.map_from_entries("kinds").alias("kinds"))
    placed = lambda x: F.struct(x["start"], x["end"], F.try_element_at("kinds", x["term"]).alias("kind"))
    places = F.filter(F.transform(_terms(F.col("text")), placed), lambda x: x["kind"].isNotNull())
    return rows.join(hits, same).select("doc", "mark", F.explode(places).alias("x")).select("doc", "mark", "x.*")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 64, **thresholds) -> DataFrame:
    """(doc, mark, base, spans) for every row: the entities' spans, and these with the terms'.

    A span is (start, kind, end) in code points, ``kind`` a place in ``KINDS``.
    """
    found = materialize(entities(docs, id_col, text_col, window), "entities")
    told = materialize(disclosing(docs, found, text_col, **thresholds), "disclosing")
    near = found.select("doc", "mark", F.explode("near").alias("n")).select("doc", "mark", "n.*")
    terms = near.join(told.select("entity", "term", "kind"), ["entity", "term"]).select("doc", "mark", "start", "end", "kind")
    terms = terms.unionByName(_everywhere(docs, found, told, id_col, text_col))
    # a term near several entities counts by what tells most
    terms = terms.groupBy("doc", "mark", "start", "end").agg(F.max("kind").alias("kind"))
    terms = terms.groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "kind", "end")).alias("terms"))
    terms = materialize(terms, "term_spans").select(F.col("doc").alias("tdoc"), F.col("mark").alias("tmark"), "terms")
    base = found.select("doc", "mark", F.transform("spans", lambda s: F.struct(s["start"], s["kind"], s["end"])).alias("base"))
    joined = base.join(terms, F.col("doc").eqNullSafe(F.col("tdoc")) & (F.col("mark") == F.col("tmark")), "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return joined.select("doc", "mark", "base", F.array_sort(F.concat("base", F.coalesce("terms", none))).alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def digest(detected: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, a digest of the entities' spans, and all spans, of ``detect``'s rows."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return detected.select(
        F.col("doc").alias(id_col), *[count(k).alias(f"n_{k}") for k in PATTERNS],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
    )


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with entities and disclosing terms replaced in ``text_col`` (of overlapping spans the first counts)."""
    doc, mark, spans_col = fresh(docs, "doc", "mark", "spans")
    spans = detect(docs, id_col, text_col, **options).select(F.col("doc").alias(doc), F.col("mark").alias(mark), F.col("spans").alias(spans_col))
    spans = materialize(spans.where(F.size(spans_col) > 0).dropDuplicates([doc, mark]), "spans")
    text, labels = F.col(f"`{text_col}`"), F.array(*[F.lit(LABELS[k]) for k in KINDS])

    def put(done: Column, s: Column) -> Column:
        before = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        new = F.struct(F.concat(done["out"], before, F.get(labels, s["kind"])).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= done["at"], new).otherwise(done)

    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    clean = F.aggregate(spans_col, zero, put, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(doc)) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col(mark))
    joined = docs.join(spans, same, "left")
    new = F.when(F.col(spans_col).isNull(), text).otherwise(clean)
    return joined.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
