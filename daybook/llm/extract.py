"""Main text of HTML pages by wrapper induction.

Pages of one host share a template. For every host up to ``references`` pages
(least hash of the page in each class of hashes) serve as references; every page
is aligned with the reference it matches best by simple tree matching, so runs
of text at the same place of the template meet at the same reference node. A run
whose text is the same on nearly all of the host's pages is constant: template.
Runs that vary are slots, and the slots' texts are the content, without what
can't be main text by its element (menus, footers, forms, ...), its role or
name, or by being mostly links. Where a page has an article or main element its
slots are those inside.

Statistics cover all pages of a host: only the references are few. Constant is
what ``share`` of the host's pages aligned with a reference, and at least
``support`` of them, say alike; pages of equal text count once, so copies of an
article don't make it a template. Pages meet references by a broadcast of a
checked size or, beyond it, by host and a salt, so a host with a third of all
pages is many tasks' work; counts are summed before the shuffle.

Defined cases: a null or empty page has an empty text; a page with a null or
unusable URL belongs to no host and is judged by itself; repeated rows are rows
of their own and get equal texts; elements deeper than 200 levels count as
children of the last one; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dom
from .common import materialize
from .lines import host_of

SALTS = 64
BROADCAST = 64 << 20
#: Places of one reference's tree are numbered from here times its number.
PLACES = 1 << 32


def references(pages: DataFrame, n: int) -> DataFrame:
    """(host, samples): up to ``n`` pages of every host, of different hash classes."""
    mark = F.xxhash64("html")
    rows = pages.where("host is not null and html != ''").select("host", F.pmod(mark, F.lit(n)).alias("class"), mark.alias("mark"), "html")
    least = rows.groupBy("host", "class").agg(F.min("mark").alias("mark"))
    # equal marks are copies but for a collision: one page remains
    found = rows.join(least, ["host", "class", "mark"]).groupBy("host", "class", "mark").agg(F.min("html").alias("html"))
    return found.groupBy("host").agg(F.array_sort(F.collect_list("html")).alias("samples"))


def _align(pages: DataFrame, id_type: str, url_type: str) -> DataFrame:
    """Each page's candidate runs with the reference nodes they are aligned with (-1: none)."""
    kind = f"page_id {id_type}, url {url_type}, host string, ref int, runs array<struct<slot: long, text: string>>"

    def run(batches):
        @lru_cache(64)
        def wrapper(samples: tuple[str, ...]):
            matcher = dom.Matcher()
            return matcher, [matcher.prepare(dom.parse(x)) for x in samples]

        def page(html: str | None, samples) -> tuple[int, list[dict]]:
            if not html:
                return -1, []
            nodes = dom.parse(html)
            runs = dom.candidates(nodes)
            if not samples:
                return -1, [{"slot": -1, "text": x.text} for x in runs]
            matcher, trees = wrapper(tuple(samples))
            if len(matcher.marks) > 200_000 or len(matcher.scores) > 200_000:  # shapes of many pages: start anew
                wrapper.cache_clear()
                matcher, trees = wrapper(tuple(samples))
            matcher.prepare(nodes)
            fit = [2 * matcher.score(nodes[0], t[0]) / (nodes[0].size + t[0].size) for t in trees]
            best = fit.index(max(fit))
            place = {a.at: b.at for a, b in matcher.pairs(nodes[0], trees[best][0])}
            return best, [{"slot": best * PLACES + place[x.at] if x.at in place else -1, "text": x.text} for x in runs]

        for batch in batches:
            done = [page(h, s) for h, s in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2), pa.array([r for r, _ in done], pa.int32()),
                    pa.array([x for _, x in done], pa.list_(pa.struct([("slot", pa.int64()), ("text", pa.string())]))),
                ],
                names=["page_id", "url", "host", "ref", "runs"],
            )

    return pages.select("page_id", "url", "host", "html", "samples").mapInArrow(run, kind)


def templates(aligned: DataFrame, share: float, support: int) -> DataFrame:
    """(host, constants): the (slot, text) marks of every host's constant nodes."""
    marked = aligned.where("host is not null and size(runs) > 0").select(
        "host", "ref", "runs", F.xxhash64(F.transform("runs", lambda r: r["text"])).alias("content")
    )
    total = marked.groupBy("host", "ref", "content").agg(F.lit(1).alias("one")).groupBy("host", "ref").agg(F.count("*").alias("total"))
    total = materialize(total.where(F.col("total") >= support), "hosts")
    said = marked.select("host", "ref", "content", F.explode("runs").alias("run")).where("run.slot >= 0")
    mark = _mark(F.col("run"))
    often = (
        said.select("host", "ref", "content", mark.alias("mark"))
        .groupBy("host", "ref", "mark", "content").agg(F.lit(1).alias("one"))
        .groupBy("host", "ref", "mark").agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= support)
    )
    constant = materialize(often, "runs").join(total, ["host", "ref"]).where(F.col("pages") >= share * F.col("total"))
    # at most one text a node of the host's references
    return constant.groupBy("host").agg(F.collect_set("mark").alias("constants"))


def _mark(run):
    return F.unhex(F.md5(F.concat_ws(":", run["slot"].cast("string"), run["text"]).cast("binary")))


def extract(
    pages: DataFrame, references_per_host: int = 3, share: float = 0.9, support: int = 5,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    samples = materialize(references(rows, references_per_host), "references")
    size = samples.agg(F.sum(F.aggregate("samples", F.lit(0).cast("long"), lambda s, x: s + F.octet_length(x)))).first()[0] or 0
    if size <= BROADCAST:
        joined = rows.join(F.broadcast(samples), "host", "left")
    else:
        salted = samples.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    aligned = materialize(_align(joined, types["page_id"], types["url"]), "aligned")
    constants = materialize(templates(aligned, share, support), "templates")
    kept = F.filter("runs", lambda r: (r["slot"] < 0) | F.col("constants").isNull() | ~F.array_contains("constants", _mark(r)))
    text = F.array_join(F.transform(kept, lambda r: r["text"]), " ")
    return aligned.join(constants, "host", "left").select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
