"""Document types from names and texts, and the changes they call for.

Rule lists are ordered data: the first rule that matches gives the type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipreport.functions.keywords import first_label, words_in
from shipreport.functions.text import clean_type, norm_name, slice_match, strip

Rules = Sequence[tuple[str, str]]

# Keywords and document types, in the order they are tried. The
# forwarder's own name is a parameter.
CONTENT_RULES: Rules = (
    ("PERMIT NO", "Export Customs"),
    ("CONTRACT OF PURCHASE AND SALE", "Commercial Invoice"),
    ("DECLARATION", "Others"),
    ("COMMERCIAL INVOICE", "Commercial Invoice"),
    ("TAX INVOICE", "Commercial Invoice"),
    ("PACKING LIST", "Packing List"),
    ("PACKING SLIP", "Packing List"),
    ("PACKING", "Packing List"),
    ("PACKLIST", "Packing List"),
    ("INVOICE", "Commercial Invoice"),
    ("{FORWARDER} INVOICE", "{Forwarder} Invoice"),
)
# The older content rules.
OLDER_CONTENT_RULES: Rules = (
    ("COMMERCIAL INVOICE", "Commercial Invoice"),
    ("PACKING LIST", "Packing List"),
    ("PERMIT", "Export Permit"),
    ("{FORWARDER} INVOICE", "{Forwarder} Invoice"),
    ("INVOICE", "Commercial Invoice"),
)
# First two letters of import customs file names.
IMPORT_CUSTOMS_PREFIXES = (
    "II", "ME", "IN", "IZ", "IR", "IM", "IT", "ID", "IG",
    "OO", "OD", "OT", "TT", "TW",
)


def for_forwarder(rules: Rules, forwarder: str) -> list[tuple[str, str]]:
    """The rules with the forwarder's name filled in."""
    names = {"{FORWARDER}": forwarder.upper(), "{Forwarder}": forwarder}
    out = []
    for word, label in rules:
        for mark, name in names.items():
            word, label = word.replace(mark, name), label.replace(mark, name)
        out.append((word, label))
    return out


def first_match(conditions: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    result = F
    for condition, label in conditions:
        result = result.when(condition, F.lit(label))
    return result.otherwise(F.lit(default).cast("string"))


# Up to so many rules one search a keyword is as fast as one pass for all.
SINGLE_SEARCHES = 16


def content_type(content: Column, rules: Rules, default: str | None = None) -> Column:
    """The type by keywords in an upper-case text; longer lists are looked for in one pass."""
    if len(rules) > SINGLE_SEARCHES:
        return first_label(content, rules, default)
    return first_match([(content.contains(word), label) for word, label in rules], default)


def is_empty(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit(""))) == ""


def name_equals_key(name: Column, key: Column) -> Column:
    """The file is named after the shipment."""
    return F.coalesce((F.length(key) > 0) & (norm_name(name) == F.upper(key)), F.lit(False))


def is_pdf(name: Column) -> Column:
    return F.upper(strip(name)).endswith(".PDF")


def name_type(name: Column, key: Column, own_type: str, house_type: str = "HAWB") -> Column:
    """The type by the file's name: the shipment's number, else a slice of it, else none."""
    return first_match([(name_equals_key(name, key), house_type), (slice_match(name, key), own_type)])


def cascade(docs: DataFrame, rules: Rules, own_type: str) -> DataFrame:
    """Documents with ``new_type``, by name or else by the content of a PDF, and without text.

    An empty text gives no type, as no keyword is in it. Texts are turned to upper case
    only where the name leaves the type open.
    """
    name, key = F.col("file_name"), F.col("house_no")
    by_name = docs.withColumn("_by_name", name_type(name, key, own_type))
    opened = by_name.withColumn("_content", F.when(F.col("_by_name").isNull() & is_pdf(name), F.upper("text")))
    found = F.coalesce(F.col("_by_name"), content_type(F.col("_content"), rules))
    return opened.withColumn("new_type", found).drop("_by_name", "_content", "text")


def name_prefix_type(name: Column, own_prefix: str,
                     prefixes: Sequence[str] = IMPORT_CUSTOMS_PREFIXES,
                     own_type: str = "HAWB", prefix_type: str = "Import Customs") -> Column:
    """The type by the beginning of the file name."""
    upper = F.upper(strip(name))
    return first_match([
        (upper.startswith(own_prefix.upper()), own_type),
        (F.substring(upper, 1, 2).isin(list(prefixes)), prefix_type),
    ])


def numbered_name(name: Column, word: str = "HAWB") -> Column:
    """The file name starts with ``word`` and three digits."""
    return F.coalesce(F.upper(strip(name)).rlike(f"^{word}[0-9]{{3}}"), F.lit(False))


def flag_type(own: Column, packing: Column, invoice: Column, own_type: str) -> Column:
    """The type by keyword flags; both words together make a commercial invoice."""
    return first_match([
        (own, own_type),
        (invoice & packing, "Commercial Invoice"),
        (packing, "Packing List"),
        (invoice, "Commercial Invoice"),
    ])


def keyword_flags(pages: DataFrame, keys: Sequence[str], text: str,
                  words: Mapping[str, str]) -> DataFrame:
    """Per document, which words occur on any of its pages.

    A keyword cannot cross a line break, so pages joined by line breaks hold it just
    when one page does; the flags merge without building the document's text. Words with
    a line break, which this would not hold for, are refused; letter case does not count.
    """
    if any("\n" in word for word in words.values()):
        raise ValueError("keywords must not hold line breaks")
    upper = F.upper(F.col(text))
    if len(words) > SINGLE_SEARCHES:
        pages = pages.withColumn("_words", words_in(upper, [w.upper() for w in words.values()]))
        holds = lambda word: F.array_contains("_words", word.upper())
    else:
        holds = lambda word: upper.contains(word.upper())
    seen = [F.coalesce(F.bool_or(holds(word)), F.lit(False)).alias(name) for name, word in words.items()]
    return pages.groupBy(*keys).agg(*seen)


def keyword_spread(docs: DataFrame, content: Column, words: Sequence[str]) -> DataFrame:
    """How many documents hold each keyword, of those that any holds: (word, documents).

    Each text is read once; the counts are partial before they are shuffled.
    """
    return docs.select(F.explode(words_in(content, words)).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("documents"))


def _page_piece(text: str, form: str) -> tuple[Column, str]:
    """What a page adds to its document's text, and what stands between two pages."""
    present = F.coalesce(F.col(text), F.lit(""))
    if form == "lines":
        return present, "\n"
    if form == "upper":
        return F.when(present != "", F.concat(F.upper(present), F.lit(" "))).otherwise(""), ""
    if form == "plain":
        return F.upper(present), ""
    raise ValueError(f"unknown form: {form}")


def page_forms(pages: DataFrame, key: str, page: str, text: str, forms: Sequence[str], chunk: int = 64) -> DataFrame:
    """The pages of each document as one text in each of several forms, from one pass.

    ``lines`` joins them by line breaks with a missing page as empty text; ``upper``
    puts a blank after each non-empty page and turns all to upper case; ``plain``
    does so without the blank. Pages are first joined in runs of ``chunk`` page
    numbers, so that a long document is spread over tasks and its last step sorts
    runs, not pages.
    """
    pieces = {form: _page_piece(text, form) for form in forms}

    def joined(order: str) -> list[Column]:
        return [F.array_join(F.array_sort(F.collect_list(F.struct(order, form))).getField(form), between).alias(form)
                for form, (_, between) in pieces.items()]

    rows = pages.select(key, F.floor(F.col(page) / chunk).alias("_run"), F.col(page).alias("_page"),
                        *[piece.alias(form) for form, (piece, _) in pieces.items()])
    return rows.groupBy(key, "_run").agg(*joined("_page")).groupBy(key).agg(*joined("_run"))


def page_concat(pages: DataFrame, key: str, page: str, text: str, form: str = "lines",
                chunk: int = 64) -> DataFrame:
    """``page_forms`` with one form, as the column ``text``."""
    return page_forms(pages, key, page, text, [form], chunk).withColumnRenamed(form, text)


def _differs(new: str) -> Column:
    return F.upper(F.col(new)) != clean_type(F.col("current_type"))


def type_changes(docs: DataFrame, new: str = "new_type") -> DataFrame:
    """A change row for each document whose new type differs from the stored one.

    Case and ``*`` marks of the stored type do not count. No new type, no change.
    """
    change = F.struct(
        "house_no",
        F.lit("Done").alias("status"),
        strip(F.col("file_name")).alias("file_name"),
        strip(F.col("current_type")).alias("old_type"),
        F.col(new).alias("new_type"),
    )
    differs = _differs(new)
    # Not a filter: the optimizer would move it below the joins and evaluate the rules
    # there, over all texts and once per mention of the new type.
    return docs.select(F.inline(F.when(differs, F.array(change))))


def change_counts(shipments: DataFrame, docs: DataFrame, new: str = "new_type",
                  total: str | None = None) -> DataFrame:
    """Documents and changes of each shipment opened, also of those without any.

    Each document is read once and says itself whether it changes. With ``total`` one more
    row of this name counts all.
    """
    changed = F.coalesce(_differs(new), F.lit(False)).cast("int")
    rows = shipments.select("house_no", F.lit(1).alias("opened"), F.lit(0).alias("doc"), F.lit(0).alias("change")).unionAll(
        docs.select("house_no", F.lit(0).alias("opened"), F.lit(1).alias("doc"), changed.alias("change")))
    sums = [F.sum("opened").alias("opened"), F.sum("doc").alias("documents"), F.sum("change").alias("changed")]
    if total is None:
        return rows.groupBy("house_no").agg(*sums)
    named = F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col("house_no"))
    return rows.rollup("house_no").agg(*sums, F.grouping("house_no").alias("_all")).withColumn("house_no", named).drop("_all")
