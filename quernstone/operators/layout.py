"""From words with places on a page to lines, reading order, paragraphs and blocks.

Words are rows (doc_id, page, width, text, x0, x1, top, bottom, size), whatever
reader gives them. Lines depend on the first word of each line, a fold inside a
page, so pages are Arrow groups; everything after is windows and grouped modes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import blocks as B
from quernstone.operators.relational import repeated_lines

#: Line tolerance (share of the size, points at least), bands, gutter width, where its centre lies, words in all and share a side.
TOLERANCE, LEAST_TOLERANCE = 0.25, 2.0
BANDS, GUTTER, CENTRE, COLUMN_WORDS, COLUMN_SHARE = 200, 0.025, (0.25, 0.75), 40, 0.2
#: Characters a page of text has, pages recognised at most, words of a title, leading where there is none.
PAGE_CHARS, RECOGNISED_PAGES, TITLE_WORDS, LEADING = 40, 200, 20, 12.0
#: Shares of unreadable marks and of lone letters that make a page unreadable.
MARK_SHARE, LETTER_SHARE = 0.30, 0.40
#: Pages that a worker reads at once.
PAGES = 512
MARK, LETTER = r"\(cid:\d+\)", r"^[A-Za-zÁÉÍÓÚÜÑáéíóúüñÇç]$"
LINE = "doc_id string, page int, line int, text string, size double, top double, bottom double, x0 double"


def gutter(words: list[dict], width: float) -> float | None:
    """Where the gap between two columns lies: the widest empty run of bands between words, near the middle, with words on both sides."""
    if len(words) < COLUMN_WORDS or width <= 0:
        return None
    step = width / BANDS
    covered: set[int] = set()
    for w in words:
        covered.update(range(max(0, int(w["x0"] / step)), min(BANDS - 1, int(w["x1"] / step)) + 1))
    taken = sorted(covered)
    gaps = [(b - a - 1, -a) for a, b in zip(taken, taken[1:], strict=False) if b > a + 1]
    if not gaps:
        return None
    n, a = max(gaps)  # the widest, the leftmost of equals
    cut = (1 - a + n / 2) * step
    left = sum(centre(w) < cut for w in words)
    wide = n * step >= GUTTER * width and CENTRE[0] * width <= cut <= CENTRE[1] * width
    return cut if wide and min(left, len(words) - left) >= COLUMN_SHARE * len(words) else None


def centre(word: dict) -> float:
    return (word["x0"] + word["x1"]) / 2


def group_lines(words: list[dict]) -> list[dict]:
    """Lines of words: one lies in a line where its top is near that of the line's first word."""
    groups: list[list[dict]] = []
    for w in sorted(words, key=lambda w: (round(w["top"], 1), w["x0"])):
        first = groups[-1][0] if groups else None
        if first and abs(w["top"] - first["top"]) <= max(LEAST_TOLERANCE, TOLERANCE * first["size"]):
            groups[-1].append(w)
        else:
            groups.append([w])
    out = []
    for g in groups:
        g.sort(key=lambda w: w["x0"])
        size = Counter(round(w["size"], 1) for w in g).most_common(1)[0][0]
        out.append({"text": " ".join(w["text"] for w in g), "size": size, "top": min(w["top"] for w in g), "bottom": max(w["bottom"] for w in g), "x0": g[0]["x0"]})
    return out


def read_lines(words: list[dict], width: float) -> list[dict]:
    """Lines of a page in reading order: the left column before the right one."""
    cut = gutter(words, width)
    if cut is None:
        return group_lines(words)
    return group_lines([w for w in words if centre(w) < cut]) + group_lines([w for w in words if centre(w) >= cut])


def _rounded(values: np.ndarray) -> np.ndarray:
    """To one decimal as Python rounds; each distinct value once."""
    distinct, at = np.unique(values, return_inverse=True)
    return np.array([round(v, 1) for v in distinct.tolist()])[at]


def lines_of_batch(pages: pa.RecordBatch) -> pa.RecordBatch:
    """:func:`read_lines` of pages (doc_id, page, width, words), without a Python object a word."""
    listed = pages.column("words")
    n = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False)
    words = listed.flatten()
    page = np.repeat(np.arange(len(n)), n)
    x0, x1, top, bottom, size = (words.field(c).to_numpy(zero_copy_only=False) for c in ("x0", "x1", "top", "bottom", "size"))
    right, ends = np.zeros(len(page), bool), np.cumsum(n)
    widths = pc.fill_null(pages.column("width"), 0.0).to_numpy(zero_copy_only=False)
    for k in np.flatnonzero((n >= COLUMN_WORDS) & (widths > 0)).tolist():
        own = slice(ends[k] - n[k], ends[k])
        cut = gutter([{"x0": a, "x1": z} for a, z in zip(x0[own].tolist(), x1[own].tolist(), strict=True)], widths[k])
        if cut is not None:
            right[own] = (x0[own] + x1[own]) / 2 >= cut
    place = 2 * page + right
    order = np.lexsort((x0, _rounded(top), place))
    # Words of one height after each other share a line whatever it is: only the first of them is looked at.
    first = np.ones(len(order), bool)
    first[1:] = (place[order][1:] != place[order][:-1]) | (top[order][1:] != top[order][:-1])
    starts = np.flatnonzero(first)
    opens, held = np.zeros(len(order), bool), None
    for at, p, t, s in zip(starts.tolist(), place[order][starts].tolist(), top[order][starts].tolist(), size[order][starts].tolist(), strict=True):
        if held is None or p != held[0] or not abs(t - held[1]) <= max(LEAST_TOLERANCE, TOLERANCE * held[2]):
            opens[at], held = True, (p, t, s)
    line = np.cumsum(opens) - 1
    order = order[np.lexsort((x0[order], line))]
    at = np.flatnonzero(opens)  # lines keep their places when their words are sorted
    ends = np.append(at, len(order))
    sizes = _rounded(size)[order]
    mode = sizes[at]
    for k in np.flatnonzero(np.minimum.reduceat(sizes, at) != np.maximum.reduceat(sizes, at)).tolist() if len(at) else ():
        mode[k] = Counter(sizes[ends[k] : ends[k + 1]].tolist()).most_common(1)[0][0]
    of = page[order][at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = of[1:] != of[:-1]
    number = np.arange(len(at)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(at) else at
    text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), words.field("text").take(pa.array(order))), " ")
    least, most = (f.reduceat(v[order], at) if len(at) else v for f, v in ((np.minimum, top), (np.maximum, bottom)))
    columns = [pages.column("doc_id").take(pa.array(of)), pages.column("page").take(pa.array(of)), pa.array(number, pa.int32()), text, *map(pa.array, (mode, least, most, x0[order][at]))]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in LINE.split(", ")])


def lines_of_pages(pages: DataFrame) -> DataFrame:
    """LINE rows of pages (doc_id, page, width, words), ``words`` an array of (text, x0, x1, top, bottom, size). No shuffle; PAGES are read at once."""
    number = lambda w, c: w[c].cast("double").alias(c)
    typed = F.transform("words", lambda w: F.struct(w["text"].alias("text"), *(number(w, c) for c in ("x0", "x1", "top", "bottom")), F.coalesce(w["size"].cast("double"), F.lit(10.0)).alias("size")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                yield lines_of_batch(batch.slice(at, PAGES))

    ready = pages.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page").cast("int").alias("page"), F.col("width").cast("double").alias("width"), typed.alias("words"))
    return ready.mapInArrow(run, LINE)


def page_lines(words: DataFrame) -> DataFrame:
    """LINE rows of all pages; a page's words are gathered, so they bound a task. Null sizes count as 10."""
    typed = words.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("page").cast("int").alias("page"), "text",
        *(F.col(c).cast("double").alias(c) for c in ("width", "x0", "x1", "top", "bottom")), F.coalesce(F.col("size").cast("double"), F.lit(10.0)).alias("size"),
    )
    listed = F.collect_list(F.struct("text", "x0", "x1", "top", "bottom", "size"))
    return lines_of_pages(typed.groupBy("doc_id", "page").agg(F.first("width").alias("width"), listed.alias("words")))


def useful_text(text: Column) -> Column:
    """A text without unreadable marks and lone letters."""
    words = F.filter(F.split(F.regexp_replace(text, MARK, " "), r"(?U)\s+"), lambda w: (w != "") & ~w.rlike(LETTER))
    return F.array_join(words, " ")


def is_illegible(text: Column) -> Column:
    """Whether a page's text is there but cannot be read; a blank one is not."""
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    marks = F.length(text) - F.length(F.regexp_replace(text, MARK, ""))
    letters = F.size(F.filter(words, lambda w: w.rlike(LETTER)))
    return (F.size(words) > 0) & ((marks / F.length(text) > MARK_SHARE) | (letters / F.size(words) > LETTER_SHARE))


def looks_like_title(text: Column) -> Column:
    return T.once(T.word_count(T.normalised(text)), lambda n: (n > 0) & (n <= TITLE_WORDS))


def _page_texts(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page, text, chars): every page, blank ones too."""
    listed = F.array_sort(F.collect_list(F.struct("line", "text")))
    texts = lines.groupBy("doc_id", "page").agg(F.array_join(F.transform(listed, lambda x: x["text"]), " ").alias("text"), F.sum(F.length("text")).alias("chars"))
    return pages.select("doc_id", "page").distinct().join(texts, ["doc_id", "page"], "left").select("doc_id", "page", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("chars", F.lit(0)).alias("chars"))


def unreadable_pages(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page) whose own text is of no use.

    Broken text is judged page by page; missing text only in documents that have
    under PAGE_CHARS characters a page, for any report has blank pages.
    """
    texts = _page_texts(lines, pages)
    scanned = texts.groupBy("doc_id").agg((F.avg("chars") < PAGE_CHARS).alias("scanned"))
    return texts.join(scanned, "doc_id").where(is_illegible(F.col("text")) | (F.col("scanned") & (F.col("chars") < PAGE_CHARS))).select("doc_id", "page")


def with_recognised(lines: DataFrame, pages: DataFrame, recognised: DataFrame, most: int = RECOGNISED_PAGES) -> tuple[DataFrame, DataFrame]:
    """Lines after recognition, and a row of facts for each document that needed it.

    ``recognised`` has (doc_id, page, line, text, conf) from any recogniser, asked
    for :func:`unreadable_pages`; of each document the first ``most`` pages count
    (the cap is the feature). A page is replaced where recognition says more. Lines
    gain ``recognised``. Facts: pages replaced, pages not bettered, mean confidence,
    whether pages were beyond the cap.
    """
    w = Window.partitionBy("doc_id").orderBy("page")
    asked = unreadable_pages(lines, pages).withColumn("r", F.row_number().over(w))
    wanted = asked.where(F.col("r") <= most).select("doc_id", "page")
    useful = lambda df, name: _page_texts(df, pages).select("doc_id", "page", F.length(useful_text(F.col("text"))).alias(name))
    new = recognised.where(F.trim("text") != "").join(wanted, ["doc_id", "page"], "left_semi")
    compared = wanted.join(useful(lines, "had"), ["doc_id", "page"]).join(useful(new, "has"), ["doc_id", "page"]).withColumn("better", F.col("has") > F.col("had"))
    better = compared.where("better").select("doc_id", "page")
    taken = new.join(better, ["doc_id", "page"], "left_semi")
    place = F.col("line").cast("double")
    own = taken.select("doc_id", "page", "line", "text", F.lit(0.0).alias("size"), place.alias("top"), (place + 1).alias("bottom"), F.lit(0.0).alias("x0"), F.lit(True).alias("recognised"))
    kept = lines.join(better, ["doc_id", "page"], "left_anti").withColumn("recognised", F.lit(False))
    sure = taken.groupBy("doc_id", "page").agg(F.avg("conf").alias("c")).groupBy("doc_id").agg(F.round(F.avg("c"), 2).alias("confidence"))
    pages_where = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("page"))))
    facts = compared.groupBy("doc_id").agg(pages_where(F.col("better")).alias("recognised_pages"), pages_where(~F.col("better")).alias("pages_not_bettered"))
    over = asked.groupBy("doc_id").agg((F.count("*") > most).alias("cut_off"))
    return kept.unionByName(own), facts.join(over, "doc_id").join(sure, "doc_id", "left")


def body_size(lines: DataFrame) -> DataFrame:
    """(doc_id, body): the most frequent line size of each document, the first met of equals."""
    counts = lines.groupBy("doc_id", F.round("size", 1).alias("size")).agg(F.count("*").alias("n"), F.min(F.struct("page", "line")).alias("first"))
    return counts.groupBy("doc_id").agg(F.min_by("size", F.struct(-F.col("n"), "first")).alias("body"))


def title_sizes(lines: DataFrame) -> DataFrame:
    """(doc_id, size, level): sizes over 1.15 times the body's, by rank within the document."""
    sizes = lines.select("doc_id", F.round("size", 1).alias("size")).distinct().join(body_size(lines), "doc_id")
    w = Window.partitionBy("doc_id").orderBy(F.desc("size"))
    return sizes.where((F.col("body") > 0) & (F.col("size") > 1.15 * F.col("body"))).select("doc_id", "size", F.least(F.dense_rank().over(w), F.lit(B.LEVELS)).alias("level"))


def paragraphs(lines: DataFrame) -> DataFrame:
    """(doc_id, page, paragraph, text, size): runs of lines of one size without a wide gap.

    The leading is the page's most frequent rounded gap of 0 to 200 between lines,
    the smallest of equals, LEADING where there is none.
    """
    w = Window.partitionBy("doc_id", "page").orderBy("line")
    stepped = lines.withColumn("_gap", F.col("top") - F.lag("top").over(w))
    gaps = stepped.where((F.col("_gap") > 0) & (F.col("_gap") < 200)).withColumn("_gap", F.bround("_gap"))
    leading = B.modal(gaps, ["doc_id", "page"], "_gap", "leading")
    ready = lines.join(leading, ["doc_id", "page"], "left").withColumn("leading", F.coalesce("leading", F.lit(LEADING))).withColumn("_page", F.struct("doc_id", "page"))
    numbered = B.paragraph_numbers(ready, "_page", "top", "size", F.col("leading"), ["line"])
    listed = F.array_sort(F.collect_list(F.struct("line", "text")))
    return numbered.groupBy("doc_id", "page", "paragraph").agg(F.array_join(F.transform(listed, lambda x: x["text"]), " ").alias("text"), F.first("size").alias("size"))


def document_blocks(lines: DataFrame) -> DataFrame:
    """(doc_id, pos, text, kind, level, path, page): blocks of documents' lines.

    Lines that most pages repeat and lines that only number pages go. Recognised
    pages (column ``recognised``, where there is one) have no sizes: each line is a
    block of kind ocr and none counts for titles.
    """
    marked = lines if "recognised" in lines.columns else lines.withColumn("recognised", F.lit(False))
    clean = T.normalised(F.col("text"))
    common = repeated_lines(marked.select("doc_id", "page", clean.alias("text")), "doc_id", "page", "text").select("doc_id", F.col("text").alias("_clean"))
    useful = marked.withColumn("_clean", clean).where(~T.is_page_noise(F.col("text"))).join(common, ["doc_id", "_clean"], "left_anti").drop("_clean")
    native = marked.where(~F.col("recognised"))
    runs = paragraphs(useful.where(~F.col("recognised"))).join(title_sizes(native), ["doc_id", "size"], "left")
    title = F.col("level").isNotNull() & looks_like_title(F.col("text"))
    printed = runs.select("doc_id", "page", F.col("paragraph").cast("long").alias("at"), "text", F.when(title, "title").otherwise("paragraph").alias("kind"), F.when(title, F.col("level")).alias("level"))
    read = useful.where("recognised").select("doc_id", "page", F.col("line").cast("long").alias("at"), "text", F.lit("ocr").alias("kind"), F.lit(None).cast("int").alias("level"))
    rows = printed.unionByName(read).withColumn("text", T.normalised(F.col("text"))).where("text <> ''")
    w = Window.partitionBy("doc_id").orderBy("page", "at")
    return B.heading_paths(rows.withColumn("pos", F.row_number().over(w) - 1)).select("doc_id", "pos", "text", "kind", "level", "path", "page")
