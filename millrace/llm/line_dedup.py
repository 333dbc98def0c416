"""Near-duplicate lines within some edits (one, where not said), by deletion neighbourhoods; native.

Lines that are equal form a class (128-bit hash, earliest place). Two classes at
edit distance one differ within one block of the line, so the rest of the line
is a key that both have. Keys over two blocks (halves) leave a few candidates;
keys over about sqrt(length) blocks narrow these to lines that differ in one
short block. That block's deletion variants are hashed with the key, and equal
variants joined: lines without the same character at the same place, or a line
and another one's variant. Edit distances are then verified on the lines.

Every step is a DataFrame operation, and no step makes pairs of a bucket: a
variant's bucket only yields its earliest line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_key, kept, release, scratch, table

#: Shorter lines (in code points) always stay: empty ones, which part paragraphs.
MIN_CHARS = 1


def _keys(line: Column, n: Column, shorter: Column, blocks: Column) -> Column:
    """A struct for each block: its key (all but the block) and the block itself.

    ``shorter`` is the length of the shorter line of a pair: ``n`` or ``n - 1``.
    """
    wide = F.ceil(shorter / blocks).cast("int")
    many = F.ceil(shorter / wide).cast("int")

    def one(j: Column) -> Column:
        left = j * wide
        right = shorter - F.least((j + 1) * wide, shorter)
        head, tail = F.substring(line, F.lit(1), left), F.substring(line, n - right + 1, right)
        return F.struct(F.xxhash64(shorter, j, head, tail).alias("key"), F.substring(line, left + 1, n - right - left).alias("mid"))

    return F.transform(F.sequence(F.lit(0), many - 1), one)


def _half_keys(line: Column, n: Column, shorter: Column) -> list[Column]:
    half = F.ceil(shorter / 2).cast("int")
    rest = shorter - half
    return [F.xxhash64(shorter, F.lit(0), F.substring(line, n - rest + 1, rest)), F.xxhash64(shorter, F.lit(1), F.substring(line, F.lit(1), half))]


def _occurrences(rows: DataFrame, min_chars: int) -> DataFrame:
    """Each long enough line with its place, hashes and half keys, but without its text."""
    lines = rows.select("doc", "fp", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("n", F.char_length("line")).where(F.col("n") >= min_chars)
    line, n = F.col("line"), F.col("n")
    keys = [*_half_keys(line, n, n), *_half_keys(line, n, n - 1)]
    place = F.col("doc").cast("decimal(38,0)") * F.lit(2**31) + F.col("line_no")
    return lines.select(
        "doc", "fp", "line_no", place.cast("decimal(38,0)").alias("place"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
        *[k.alias(f"k{i}") for i, k in enumerate(keys)],
    )


def _shared(keyed: DataFrame, keep: list[str]) -> DataFrame:
    """Rows (``key`` and ``keep``) whose key another row has too."""
    often = keyed.groupBy("key").count().where("count > 1").select("key")
    return keyed.join(often, "key", "left_semi").select("key", *keep)


def _lines_at(texts: DataFrame, places: DataFrame, carry: list[str]) -> DataFrame:
    """``line`` of each row of ``places`` (doc, fp, line_no and ``carry``)."""
    lists = places.groupBy("doc", "fp").agg(F.collect_set(F.struct("line_no", *carry)).alias("_at"))
    found = texts.join(lists, ["doc", "fp"]).select(F.split("text", "\n").alias("_lines"), F.explode("_at").alias("_p"))
    return found.select(*[F.col("_p")[c].alias(c) for c in carry], F.col("_lines")[F.col("_p.line_no")].alias("line"))


def repeated_lines(texts: DataFrame, min_chars: int = MIN_CHARS, edits: int = 1) -> DataFrame:
    """``doc, fp, line_no`` of each line that equals an earlier line or is ``edits`` or fewer edits from one.

    ``texts`` has ``doc`` (sortable id), ``fp`` (the text's hash) and ``text``.
    """
    if edits < 0:
        raise ValueError("edits is a number of edits")
    seen = kept(_occurrences(texts, min_chars))
    classes = seen.groupBy("h1", "h2").agg(F.min("place").alias("lead"), F.count(F.lit(1)).alias("many"), *[F.min(f"k{i}").alias(f"k{i}") for i in range(4)])
    classes = scratch(classes)
    if not edits:
        again = seen.join(classes.where("many > 1").select("h1", "h2", "lead"), ["h1", "h2"])
        return _settled(again.where("place > lead"), seen)

    if edits > 1:
        gone = _near_by_many(texts, seen, classes, edits).withColumn("near", F.lit(True))
        return _marked(seen, classes, gone)

    # Halves: classes that share one with another class.
    halves = classes.select("h1", "lead", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key"))
    near = _shared(halves, ["h1", "lead"]).select("h1", "lead").distinct()
    places = seen.join(near, (seen.h1 == near.h1) & (seen.place == near.lead)).select("doc", "fp", "line_no", near.h1, "lead")
    lines = scratch(_lines_at(texts, places, ["h1", "lead"]).distinct())

    # Blocks of about sqrt(length): classes that agree in all but one of them.
    n = F.char_length("line")
    sized = lines.withColumn("n", n).withColumn("shorter", F.explode(F.array(n, n - 1))).where("shorter > 0")
    blocks = sized.select("h1", "lead", (F.col("n") - F.col("shorter")).alias("longer"), F.inline(_keys(F.col("line"), F.col("n"), F.col("shorter"), F.ceil(F.sqrt("shorter")))))
    close = _shared(blocks, ["h1", "lead", "longer", "mid"])

    # Deletion variants of the block. at: the deleted place, -1: nothing deleted.
    size = F.char_length("mid")
    variant = F.transform(F.sequence(F.lit(-1), size - 1), lambda i: F.struct(i.alias("at"), F.xxhash64("key", F.when(i < 0, F.col("mid")).otherwise(F.concat(F.substring("mid", F.lit(1), i), F.substring("mid", i + 2, size)))).alias("v")))
    rows = close.select("h1", "lead", "longer", F.inline(variant)).where("not (longer = 1 and at = -1)")
    # Equal length: same variant, same place. Lengths that differ: the whole of one, any variant of the other.
    best = rows.selectExpr(
        "h1", "lead",
        "case when longer = 0 and at >= 0 then min(case when longer = 0 then struct(lead, h1) end) over (partition by v, at) end as same",
        "case when longer = 1 then min(case when at = -1 then struct(lead, h1) end) over (partition by v) end as whole",
        "case when at = -1 then min(case when longer = 1 then struct(lead, h1) end) over (partition by v) end as part",
    )
    pairs = best.select("h1", "lead", F.explode(F.array("same", "whole", "part")).alias("e")).where("e is not null and e.lead < lead")
    pairs = scratch(pairs.selectExpr("h1", "lead", "e.h1 as other", "e.lead as other_lead").distinct(), few=8)

    # Verify on the lines themselves.
    named = lines.select("h1", "lead", "line")
    other = lines.selectExpr("h1 as other", "lead as other_lead", "line as other_line")
    true = pairs.join(named, ["h1", "lead"]).join(other, ["other", "other_lead"]).where(F.levenshtein("line", "other_line", 1) == 1)
    gone = true.select("h1", "lead").distinct().withColumn("near", F.lit(True))

    return _marked(seen, classes, gone)


def _marked(seen: DataFrame, classes: DataFrame, gone: DataFrame) -> DataFrame:
    """Places of lines whose class has an earlier one, or is ``near`` an earlier class."""
    marks = classes.join(gone, ["h1", "lead"], "left").where("many > 1 or near").select("h1", "h2", "lead", "near")
    again = seen.select("doc", "fp", "line_no", "place", "h1", "h2").join(marks, ["h1", "h2"])
    return _settled(again.where("place > lead or near"), seen)


#: Lines of one key that are compared with one another (two edits or more); the variants of more than that are joined.
FEW = 16
#: Stands for a blanked code point in a variant, whose place is part of the variant too.
_ANY = "\uffff"


def _shifts(edits: int, steps: int) -> list[tuple[int, ...]]:
    """How far text may have moved after each of ``steps`` edited blocks, with ``edits`` edits in all; the last is the difference in length."""
    ways: list[tuple[tuple[int, ...], int]] = [((), 0)]
    for _ in range(steps):
        ways = [((*w, x), used + abs(x - (w[-1] if w else 0))) for w, used in ways for x in range(-edits, edits + 1) if used + abs(x - (w[-1] if w else 0)) <= edits]
    return [w for w, _ in ways if w[-1] >= 0]


def _near_by_many(texts: DataFrame, seen: DataFrame, classes: DataFrame, edits: int) -> DataFrame:
    """``h1, lead`` of classes that are two or more edits at most (``edits``) from an earlier class.

    The scheme of one edit, for more. Of ``edits + 1`` parts of a line one has
    no edit: lines that share none with another drop out. Of about sqrt(length)
    blocks no more than ``edits`` have one: the others, where the edits before
    would have moved them, are the key. The edited blocks' variants leave out or
    blank ``edits`` code points at most; blanks must be at the same places and
    count once, left out ones on either side count each. Variants are only made
    where more than FEW lines have a key. Lines with equal
    variants whose counts are within the bound are within it, and a variant's
    bucket only yields its earliest line.
    """
    k = edits
    lines = scratch(_lines_at(texts, seen.join(classes.select(F.col("h1").alias("c1"), "lead"), (F.col("h1") == F.col("c1")) & (F.col("place") == F.col("lead"))).select("doc", "fp", "line_no", "h1", "lead"), ["h1", "lead"]).distinct())
    line, n = F.col("line"), F.col("n")
    at = lambda start, length: F.substring(line, start.cast("int") + 1, length.cast("int"))
    sized = lines.withColumn("n", F.char_length("line"))

    # Parts: a line of n code points beside one of n - d, of which a part lies moved by ``by``.
    moves = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(x).alias("by")) for d in range(k + 1) for x in range(-k, k + 1) if abs(x) + abs(d - x) <= k])
    parts = sized.select("h1", "lead", "line", "n", F.explode(moves).alias("m")).withColumn("s", n - F.col("m.d")).where("s > 0")
    wide = F.ceil(F.col("s") / (k + 1)).cast("int")
    parts = parts.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(k)))).withColumns({"from": F.col("j") * wide, "to": F.least((F.col("j") + 1) * wide, F.col("s"))})
    parts = parts.where("from <= to and from + m.by >= 0")
    part_keys = parts.select("h1", "lead", F.xxhash64("s", "j", at(F.col("from") + F.col("m.by"), F.col("to") - F.col("from"))).alias("key")).distinct()
    near = scratch(_shared(part_keys, ["h1", "lead"]).select("h1", "lead").distinct(), few=4)
    sized = sized.join(near, ["h1", "lead"])

    # Blocks: all but ``edits`` of them as the key, with every way in which these may have moved what is behind.
    rows = sized.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(k)))).withColumn("s", n - F.col("d")).where("s > 0")
    short = rows.where(F.col("s") <= k).select("h1", "lead", F.xxhash64(F.lit(-1), "s").alias("key"), F.col("line").alias("mid"))
    wide = F.ceil(F.col("s") / F.greatest(F.lit(2 * k + 2), F.ceil(F.sqrt("s")))).cast("int")
    rows = rows.where(F.col("s") > k).withColumn("w", wide).withColumn("many", F.ceil(F.col("s") / F.col("w")).cast("int"))
    ways = F.array(*[F.struct(*[F.lit(x).alias(f"m{i + 1}") for i, x in enumerate(w)]) for w in _shifts(k, k)])
    rows = rows.withColumn("by", F.explode(ways)).where(F.col(f"by.m{k}") == F.col("d"))
    for i in range(1, k + 1):
        first = F.lit(0) if i == 1 else F.col(f"j{i - 1}") + 1
        rows = rows.withColumn(f"j{i}", F.explode(F.sequence(first, F.col("many") - (k - i) - 1)))
    moved = [F.lit(0), *[F.col(f"by.m{i}") for i in range(1, k + 1)]]
    begin = [F.col(f"j{i}") * F.col("w") for i in range(1, k + 1)]
    end = [F.least((F.col(f"j{i}") + 1) * F.col("w"), F.col("s")) for i in range(1, k + 1)]
    good = F.lit(True)
    for i in range(k):
        good = good & (begin[i] + moved[i] >= 0) & (end[i] + moved[i + 1] >= begin[i] + moved[i])
    same = [at(F.lit(0), begin[0]), *[at(end[i] + moved[i + 1], (begin[i + 1] if i + 1 < k else F.col("s")) - end[i]) for i in range(k)]]
    mids = [at(begin[i] + moved[i], end[i] + moved[i + 1] - begin[i] - moved[i]) for i in range(k)]
    blocks = rows.where(good).select("h1", "lead", F.xxhash64("s", *[f"j{i}" for i in range(1, k + 1)], *same).alias("key"), F.concat_ws("\n", *mids).alias("mid"))
    keyed = scratch(_shared(blocks.unionByName(short).distinct(), ["h1", "lead", "mid"]))
    sizes = keyed.groupBy("key").agg(F.count_distinct("h1", "lead").alias("c")).where("c > 1")

    # A key of FEW lines: each with the ones before it, no more than FEW.
    few = keyed.join(sizes.where(F.col("c") <= FEW).select("key"), "key", "left_semi").select("key", "h1", "lead").distinct()
    pairs = few.join(few.selectExpr("key", "h1 as other", "lead as other_lead"), "key").where("other_lead < lead").select("h1", "lead", "other", "other_lead")

    # Of more, variants of the edited blocks, an edit at a time.
    close = keyed.join(sizes.where(F.col("c") > FEW).select("key"), "key", "left_semi")
    now = close.withColumns({"next": F.lit(1), "blank": F.lit(0), "out": F.lit(0), "spots": F.lit("")})
    variants = now
    for _ in range(k):
        now = now.where(F.col("next") <= F.char_length("mid")).withColumn("i", F.explode(F.sequence(F.col("next"), F.char_length("mid")))).where(F.substring("mid", F.col("i"), F.lit(1)) != "\n")
        left, right = F.substring("mid", F.lit(1), F.col("i") - 1), F.substring("mid", F.col("i") + 1, F.char_length("mid"))
        blank = now.select("h1", "lead", "key", F.concat(left, F.lit(_ANY), right).alias("mid"), (F.col("i") + 1).alias("next"), (F.col("blank") + 1).alias("blank"), "out", F.concat_ws(",", "spots", F.col("i").cast("string")).alias("spots"))
        out = now.select("h1", "lead", "key", F.concat(left, right).alias("mid"), F.col("i").alias("next"), "blank", (F.col("out") + 1).alias("out"), "spots")
        now = blank.unionByName(out)
        variants = variants.unionByName(now)
    variants = variants.select("h1", "lead", F.xxhash64("key", "mid", "spots").alias("v"), (k - F.col("blank") - F.col("out")).alias("left"), "out").distinct()
    first = [F.min(F.when(F.col("out") <= t, F.struct("lead", "h1"))).alias(f"e{t}") for t in range(k + 1)]
    often = variants.groupBy("v").agg(F.count_distinct("h1").alias("c"), *first).where("c > 1").drop("c")
    found = variants.join(often, "v").select("h1", "lead", F.array(*[f"e{t}" for t in range(k + 1)])[F.col("left")].alias("e")).where("e is not null and e.lead < lead")
    pairs = scratch(pairs.unionByName(found.selectExpr("h1", "lead", "e.h1 as other", "e.lead as other_lead")).distinct(), few=8)

    true = pairs.join(lines, ["h1", "lead"]).join(lines.selectExpr("h1 as other", "lead as other_lead", "line as other_line"), ["other", "other_lead"])
    return true.where(F.levenshtein("line", "other_line", k) >= 0).select("h1", "lead").distinct()


def _settled(gone: DataFrame, seen: DataFrame) -> DataFrame:
    """The places of ``gone``, written; ``seen`` is given back."""
    out = scratch(gone.select("doc", "fp", "line_no"), few=4)
    release(seen)
    return out


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = 1) -> DataFrame:
    """Remove each line that equals, or is ``edits`` edits (one) or fewer away from, an earlier line.

    Lines are split at ``\\n``; earlier is a smaller doc_id, or the same document
    and a smaller line number. Lines are judged on the input, not on what is
    left. Lines of fewer than ``min_chars`` code points always stay. An edit
    inserts, deletes or replaces one code point; with ``edits`` 0 only equal
    lines go. Each edit more makes keys and variants many times as many (two: up
    to some thousand for a line that shares a third with another).

    Returns the columns of ``docs`` with ``text`` made of the lines that stay,
    and ``n_lines`` and ``n_removed`` (columns of these names are replaced).
    Null texts stay null and have no lines; an empty text has one, which stays.
    Null ids come before all others. Rows of one id are compared by line number
    only: equal rows get equal results, and neither is earlier than the other.
    """
    docs = docs.drop("n_lines", "n_removed")
    others = [c for c in docs.columns if c != "text"]
    texts = docs.select(F.struct(*others).alias("_row"), F.col("text").cast("string").alias("text"), doc_key().alias("doc"), F.xxhash64("text").alias("fp"))
    gone = repeated_lines(texts, min_chars, edits).groupBy("doc", "fp").agg(F.collect_set("line_no").alias("_gone"))
    joined = texts.join(gone, ["doc", "fp"], "left").withColumn("_lines", F.split("text", "\n"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone")), lambda i: F.col("_lines")[i])
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: DuckDB: distinct lines of lengths that differ by one at most and that share a half, without one code point each
#: (of equal lengths) or one code point of the longer one (its levenshtein would count bytes).
ORACLE = r"""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as no from documents
), c as (
  select line, length(line) as n, min(struct_pack(d := doc_id, l := no)) as f, md5(substr(line, 1, (length(line) // 2)::int)) as p from l where length(line) > 0 group by line
), near as (
  select distinct a.line from c a join c b on b.n between a.n - 1 and a.n + 1 and b.f < a.f
    and (left(a.line, (least(a.n, b.n) // 2)::int) = left(b.line, (least(a.n, b.n) // 2)::int) or right(a.line, (least(a.n, b.n) // 2)::int) = right(b.line, (least(a.n, b.n) // 2)::int))
    and len(list_filter(range(greatest(a.n, b.n)), lambda i: case when a.n = b.n then left(a.line, i::int) || substr(a.line, i::int + 2) = left(b.line, i::int) || substr(b.line, i::int + 2)
      when a.n > b.n then left(a.line, i::int) || substr(a.line, i::int + 2) = b.line else left(b.line, i::int) || substr(b.line, i::int + 2) = a.line end)) > 0
), m as (
  select l.doc_id, l.no, l.line, coalesce(l.no is not null and c.line is not null and (struct_pack(d := l.doc_id, l := l.no) > c.f or near.line is not null), false) as gone
  from l left join c on c.line = l.line left join near on near.line = l.line
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by no) filter (where not gone), '')) as kept_sha256
from m group by doc_id
"""
