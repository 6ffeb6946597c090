"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Four patterns of characters find the base spans: email, ip, card and phone. They are the seeds. The words around
a seed make lexical patterns ("two words before", "a word before and one after"). Other tokens with digits or
an @ are candidates; with the seeds they form a graph of patterns and instances. Its scores are computed in turns: a
pattern scores by the share of its instances that are known to be of a kind, an instance by the patterns it
occurs in. Candidates that occur in patterns of high confidence, with enough different seeds behind them, become spans.

The expressions on characters are written so that Java neither recurses per character nor tries a run of characters
again from each place, which long texts would not survive; each finds just what the plain form in its comment finds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.llm.common import SPACES, Scratch, growing, text_or_empty, with_row_id

KINDS = ("email", "ip", "card", "phone")
TOLERANCE = 0.01  # turns end when no pattern's score moves further
LEAST_SEEDS = 3  # different seeds of a kind in a pattern
SMOOTHING = 0.5  # unknown instances added to each pattern's: three seeds alone make 3 / 3.5 = 0.86
PATTERN_SCORE = 0.8
INSTANCE_SCORE = 0.8
CONTEXT_CHARS = 64
ROW = "__truegrain_row"
PIECES = "array<struct<kind:string,nth:int,gap:int,value:string,before:string,after:string>>"
MARK, DASH = "\ufffe", "\uffff"  # stand for a separator inside a match; noncharacters, replaced where a text has them
PIECES_BESIDE = 33  # a match and the gap after it have two characters or more, so that these fill a context
LABEL, LOCAL = "A-Za-z0-9-", f"A-Za-z0-9._%+{MARK}-"

#: Where separators that a match may run over are marked: a space or a dash between digits, dots between labels.
MARKED = {
    "card": ((r"(?<=[0-9])\x20(?=[0-9])", MARK), (r"(?<=[0-9])-(?=[0-9])", DASH)),
    "email": ((rf"(?<=[{LABEL}])\.(?=[{LABEL}])", MARK),),
}
FIND = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[{LABEL}]++{MARK}[{MARK}{LABEL}]++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": rf"[0-9][0-9{MARK}{DASH}]++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # a word with a digit or an @
    "token": r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D0-9@]*+[0-9@])[^\x20\x09-\x0D]++",
}
#: Texts without this cannot hold a match.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "token": "[0-9@]"}
BYTE = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"


def _luhn(digits: Column) -> Column:
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), lambda d: d.cast("int"))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def _holds(kind: Column, value: Column) -> Column:
    """Whether a match of a base kind passes the test of its kind."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", F.forall(F.split(value, r"\."), lambda p: p.rlike(BYTE)))
        .when(kind == "card", n.between(12, 19) & _luhn(F.when(n.between(12, 19), digits)))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(False)
    )


def matches(docs: DataFrame) -> DataFrame:
    """All base matches that pass, and all tokens: row, doc_id, kind, start, end, value, and the text before and after,
    taken from the whole text, so that other matches beside it are part of it.

    Places are code points, ``end`` exclusive. Every kind is matched from left to right, without overlap. Each document also
    has one row of kind "document", so that the table is read once for all that follows.
    """
    text = F.translate(text_or_empty(), MARK + DASH, "\ufffd\ufffd")
    steps = with_row_id(docs, ROW).select(ROW, "doc_id", text.alias("text"))
    for kind in FIND:
        on = F.col("text")
        for pattern, mark in MARKED.get(kind, ()):
            on = F.regexp_replace(on, pattern, mark)
        steps = steps.withColumn(f"{kind}_on", F.when(F.col("text").rlike(NEEDS[kind]), on))
    parts = [ROW, "doc_id"]
    for kind, pattern in FIND.items():
        parts.append(F.split(f"{kind}_on", pattern, -1).alias(f"{kind}_gaps"))
        parts.append(F.regexp_extract_all(f"{kind}_on", F.lit(pattern), F.lit(0)).alias(f"{kind}_hits"))
    steps = steps.select(*parts)

    def pieces(kind: str) -> Column:
        """The text beside a match is put together from gaps and matches around it, each cut to what a context can hold."""
        gaps, hits = F.col(f"{kind}_gaps"), F.col(f"{kind}_hits")
        tail, head = lambda c: F.right(c, F.lit(CONTEXT_CHARS)), lambda c: F.substring(c, 1, CONTEXT_CHARS)
        first = F.array(F.lit("")).cast("array<string>")
        upto = F.zip_with(F.concat(first, hits), gaps, lambda h, g: tail(F.concat(tail(h), tail(g))))
        onward = F.zip_with(gaps, F.concat(hits, first), lambda g, h: head(F.concat(head(g), head(h))))
        # Bound once a row: a column that a lambda names could be worked out again for each element.
        bound = F.array(F.struct(gaps.alias("gaps"), hits.alias("hits"), upto.alias("upto"), onward.alias("onward")))

        def plain(context: Column) -> Column:
            return F.translate(context, MARK + DASH, {"card": " -", "email": "."}.get(kind, ""))

        def cut(row: Column) -> Column:
            def one(hit: Column, i: Column) -> Column:
                start = F.greatest(i + 2 - PIECES_BESIDE, F.lit(1))
                return F.struct(
                    F.lit(kind).alias("kind"),
                    i.alias("nth"),
                    F.length(F.get(row["gaps"], i)).alias("gap"),
                    hit.alias("value"),
                    plain(tail(F.array_join(F.slice(row["upto"], start, i + 2 - start), ""))).alias("before"),
                    plain(head(F.array_join(F.slice(row["onward"], i + 2, PIECES_BESIDE), ""))).alias("after"),
                )

            return F.transform(row["hits"], one)

        return F.when(hits.isNotNull(), F.flatten(F.transform(bound, cut))).otherwise(F.array().cast(PIECES))

    whole = F.array(F.struct(F.lit("document"), F.lit(0), F.lit(0), F.lit(""), F.lit(""), F.lit(""))).cast(PIECES)
    every = F.explode(F.concat(whole, *(pieces(k) for k in FIND))).alias("m")
    rows = steps.select(ROW, "doc_id", every).select(ROW, "doc_id", "m.*")
    sofar = Window.partitionBy(ROW, "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum((F.col("gap") + F.length("value")).cast("long")).over(sofar)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    passing = placed.where(F.col("kind").isin("token", "document") | _holds(F.col("kind"), F.col("value")))
    return passing.select(ROW, "doc_id", "kind", "start", "end", "value", "before", "after")


def _occurrences(found: DataFrame) -> DataFrame:
    """Base spans, and the tokens that no base span overlaps, with their instance and patterns."""
    base = F.col("kind") != "token"
    in_row = Window.partitionBy(ROW).orderBy("start", "end")
    back = Window.partitionBy(ROW).orderBy(F.desc("start"))
    before = F.max(F.when(base, F.col("end"))).over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    # Ties of start: a base span that starts where the token does overlaps it from either side.
    after = F.min(F.when(base, F.col("start"))).over(back.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    free = (F.coalesce("__before", F.lit(0)) <= F.col("start")) & (F.col("__after").isNull() | (F.col("__after") >= F.col("end")))
    alone = found.withColumn("__before", before).withColumn("__after", after).where(base | free)
    words = {
        "l": F.filter(F.split(F.regexp_replace(F.lower("before"), "[0-9]", "0"), SPACES), lambda w: w != ""),
        "r": F.filter(F.split(F.regexp_replace(F.lower("after"), "[0-9]", "0"), SPACES), lambda w: w != ""),
    }
    told = alone.withColumns(words)
    last, ahead = F.try_element_at("l", F.lit(-1)), F.try_element_at("l", F.lit(-2))
    following = F.try_element_at("r", F.lit(1))
    # concat is null where a word is missing: such a pattern is left out.
    patterns = F.array_compact(F.array(F.concat(ahead, F.lit(" "), last, F.lit(" _")), F.concat(last, F.lit(" _ "), following)))
    digits = F.regexp_replace("value", "[^0-9]", "")
    instance = F.when(F.col("value").contains("@"), F.lower("value")).otherwise(digits)
    return told.select(ROW, "kind", "start", "end", instance.alias("instance"), patterns.alias("patterns"))


def _suits(kind: Column, instance: Column) -> Column:
    """Whether an unseen instance can be of a kind: an address needs an @, a number seven digits, an ip four."""
    n = F.length(instance)
    mail = instance.contains("@")
    return F.when(kind == "email", mail).when(kind == "ip", ~mail & n.between(4, 12)).otherwise(~mail & n.between(7, 19))


def discovered(scratch: Scratch, occurrences: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(row, kind, start, end) of candidates that patterns of high confidence find.

    Scores only grow from turn to turn, as seeds are certain and candidates start at nothing, and none exceeds 1; turns go on until
    no pattern gains more than ``tolerance``.
    """
    edges = occurrences.select("instance", "kind", F.explode("patterns").alias("pattern"))
    seeds = scratch.store(edges.where("kind <> 'token'").select("instance", "kind").distinct())
    hopeful = edges.where("kind <> 'token'").groupBy("pattern").agg(F.count_distinct("instance").alias("n"))
    hopeful = scratch.store(hopeful.where(F.col("n") >= LEAST_SEEDS).select("pattern"))  # others never score
    graph = scratch.store(edges.join(growing(hopeful), "pattern", "left_semi").select("pattern", "instance").distinct())
    totals = scratch.store(graph.groupBy("pattern").agg(F.count("*").alias("instances")))
    known = seeds.withColumn("score", F.lit(1.0)).withColumn("seed", F.lit(True))
    scores, moved = None, 1.0
    while moved > tolerance:
        told = graph.join(growing(known), "instance").groupBy("pattern", "kind")
        masses = scratch.store(told.agg(F.sum("score").alias("mass"), F.count_if("seed").alias("seeds")))
        share = (F.col("mass") / (F.col("instances") + SMOOTHING)).alias("score")
        before, scores = scores, scratch.store(
            masses.where(F.col("seeds") >= LEAST_SEEDS).join(growing(totals), "pattern").select("pattern", "kind", share)
        )
        gain = scores.select("pattern", "kind", "score", F.lit(0.0).alias("was"))
        if before is not None:
            gain = scores.join(growing(before.withColumnRenamed("score", "was")), ["pattern", "kind"], "left")
        moved = gain.agg(F.max(F.col("score") - F.coalesce("was", F.lit(0.0)))).first()[0] or 0.0
        missed = F.exp(F.sum(F.log(F.lit(1.0) - F.col("score"))))
        found = graph.join(growing(scores), "pattern").groupBy("instance", "kind").agg((1 - missed).alias("score"))
        found = found.where(_suits(F.col("kind"), F.col("instance"))).join(growing(seeds), ["instance", "kind"], "left_anti")
        known = scratch.store(
            found.withColumn("seed", F.lit(False)).unionByName(seeds.withColumn("score", F.lit(1.0)).withColumn("seed", F.lit(True)))
        )
    sure = scores.where(F.col("score") >= PATTERN_SCORE)
    likely = known.where(F.col("score") >= INSTANCE_SCORE).select("instance", "kind", "score")
    open_ = occurrences.where("kind = 'token'").select(ROW, "start", "end", "instance", F.explode("patterns").alias("pattern"))
    met = open_.join(growing(sure.select("pattern", "kind")), "pattern").join(growing(likely), ["instance", "kind"])
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    best = F.min_by("kind", F.struct(-F.col("score"), order))
    suits = met.where(_suits(F.col("kind"), F.col("instance")))
    return suits.groupBy(ROW, "start", "end").agg(best.alias("kind")).select(ROW, "kind", "start", "end")


def personal_data(docs: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Per document: row number, doc_id, n_email, n_ip, n_card, n_phone, base and spans.

    ``base`` and ``spans`` are arrays of (start, kind, end), ordered by start, then by kind in the order of KINDS;
    ``base`` and the counts hold what the four patterns of characters find, ``spans`` also what contexts find. A null text
    is empty and has no spans. Rows are judged by themselves, repeated ones too. Other columns are not looked at.
    A context is what stands within ``CONTEXT_CHARS`` characters of a match: of a longer word its nearest part is the word.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    found = scratch.store(matches(docs))
    occurrences = scratch.store(_occurrences(found.where("kind <> 'document'")))
    base = occurrences.where("kind <> 'token'").select(ROW, "kind", "start", "end", F.lit(True).alias("base"))
    more = discovered(scratch, occurrences, tolerance).withColumn("base", F.lit(False))
    whole = found.where("kind = 'document'").select(ROW, "doc_id", F.lit(True).alias("whole"))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.when(F.col("whole").isNull(), F.struct("start", order.alias("nth"), "end", "kind"))
    counts = [F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS]
    rows = whole.unionByName(base.unionByName(more), allowMissingColumns=True)
    return rows.groupBy(ROW).agg(
        F.max("doc_id").alias("doc_id"),  # the others of the group are null
        *counts,
        F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.sort_array(F.collect_list(span)).alias("spans"),
    )


def joined(spans: str) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
