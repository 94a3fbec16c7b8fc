"""Form documents made of the customer table: one kind of document for each way through the extraction.

The kind is the customer's number modulo twelve, and the market segment is a word of the texts, so
that what the extraction has to find can be said in SQL from the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A page with a text layer needs some characters.
FILLER = "Plain words that make this page long enough to count as a page with text."
START = "Form CIC 36\\nthe company will benefit below people of the valley who work with {w}\\nSECTION B"
HEAD = "SECTION B: Community Interest Statement - Activities & Related Benefit"
SURPLUS = "If the company makes any surplus it will be used for new {w} tools."
DIFFERS = "Our company differs from a general commercial company because it is owned by its {w} workers."

#: Pages of each kind, in order: (text, whether it is in the text layer; else it is what recognition reads).
KINDS: dict[int, list[tuple[str, bool]]] = {
    # 0 text layer: the section's lines are one activity
    0: [
        (f"Form CIC 36 {FILLER}\\nThe company's activities will provide benefit to: people of the valley who work with {{w}}\\nSECTION B", True),
        (f"Section B: Activities and Related Benefit\\nWe teach {{w}} to adults.\\nWe lend {{w}} to schools.\\n{DIFFERS}\\n{SURPLUS}\\nSection C", True),
        (FILLER, True),
    ],
    # 1 text layer with tables (see TABLES)
    1: [(f"Form CIC 36 {FILLER}", True), (f"Section B: Activities and Related Benefit\\nWe teach {{w}}.\\n{SURPLUS}\\nSection C", True)],
    # 2 hybrid; columns read line by line
    2: [
        (f"{START} {FILLER}", True),
        (f"{HEAD}\\nWe run a weekly {{w}} class in the village hall for all ages.\\nThe community will benefit by learning {{w}} skills all year.\\n{DIFFERS}\\n{SURPLUS}\\nSECTION C", False),
    ],
    # 3 numbered rows
    3: [(START, False), (f"{HEAD}\\n{SURPLUS}\\n1. We teach {{w}} to adults. It helps people find work.\\n2. We lend {{w}} to schools. Pupils learn to use it.\\nSECTION C", False)],
    # 4 the section refers to another one, behind it
    4: [
        (START, False),
        (f"{HEAD}\\nPlease see attached appendix for the work of the company.\\n{SURPLUS}\\nSECTION C", False),
        ("nothing", False),
        ("Section B: Activities\\nWe repair {w} for poor families of the valley.\\nThe community will benefit by saving money on repairs.\\nSection C", False),
    ],
    # 5 word boxes in two columns (see word_boxes)
    5: [(START, False), (f"{HEAD}\\nWe run and people learn\\n{DIFFERS}\\n{SURPLUS}\\nSECTION C", False)],
    # 6 no form
    6: [("A letter about {w}", False), ("and nothing else", False)],
    # 7 a form without its section
    7: [(START, False), ("A letter about {w}", False)],
    # 8 the section holds another form's content
    8: [(START, False), (f"{HEAD}\\nApplication to register a company that sells {{w}} to the public.\\n{SURPLUS}\\nSECTION C", False)],
    # 9 too little for any parser: the lines themselves
    9: [(START, False), (f"{HEAD}\\nHire of {{w}}", False)],
    # 10 no page can be recognised
    10: [("broken", False), ("broken", False)],
    # 11 the file can't be read: no pages
    11: [],
}

#: Cells of kind 1's second page: (strategy, number, rows).
TABLES = [
    (0, 0, [["Activities", "How will the activity benefit the community"], ["Classes in {w}", "Skills for adults"], ["CLASSES IN {W}", "skills for adults"], ["", "lost"], ["one"]]),
    (0, 1, [["Activities", "Benefit to the community"], ["Loans of {w}", " Tools \\n for schools "]]),
    (1, 0, [["Activities", "Benefit to the community"], ["Never read", "as the first strategy found some"]]),
]
LEFT = ["We run a weekly {w} class for adults", "in the village hall on every Monday evening"]
RIGHT = ["People of the valley learn a trade", "and earn more in it than before"]


def _with(text: str) -> Column:
    """A text with the segment in place of its mark."""
    parts = text.replace("\\n", "\n").replace("{W}", "{w}").split("{w}")
    return F.concat_ws("", *[x for i, p in enumerate(parts) for x in ([F.col("w")] if i else []) + [F.lit(p)]])


def documents(customer: DataFrame) -> DataFrame:
    """doc_id, kind and w (the segment in lower case).

    A customer is a few bytes in its file and some pages here, so that one task would get very many
    documents: they are dealt over tasks, by doc_id as all that follows.  A few for each core, as the
    plan is large and many small tasks took longer.
    """
    docs = customer.select(F.concat(F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.lit(".pdf")).alias("doc_id"), (F.col("c_custkey") % len(KINDS)).cast("int").alias("kind"), F.lower("c_mktsegment").alias("w"))
    return docs.repartition(3 * customer.sparkSession.sparkContext.defaultParallelism, "doc_id")


def _pages(docs: DataFrame) -> DataFrame:
    none = F.array().cast("array<struct<text:string,layer:boolean>>")
    listed = none
    for kind, pages in KINDS.items():
        if pages:
            listed = F.when(F.col("kind") == kind, F.array(*[F.struct(_with(x).alias("text"), F.lit(layer).alias("layer")) for x, layer in pages])).otherwise(listed)
    out = docs.select("doc_id", "kind", F.posexplode(listed).alias("i", "p"))
    return out.select("doc_id", "kind", (F.col("i") + 1).cast("int").alias("page_num"), "p.text", "p.layer")


def text_layer(docs: DataFrame) -> DataFrame:
    return _pages(docs).select("doc_id", "page_num", F.when(F.col("layer"), F.col("text")).otherwise("").alias("text"))


def recognised(docs: DataFrame) -> DataFrame:
    """What recognition gives for the other pages: doc_id, page_num, text, error."""
    broken = F.col("kind") == 10
    return _pages(docs).where("not layer").select("doc_id", "page_num", F.when(~broken, F.col("text")).alias("text"), F.when(broken, F.lit("ValueError: no image")).alias("error"))


def tables(docs: DataFrame) -> DataFrame:
    cells = lambda rows: F.array(*[F.array(*[F.upper(_with(c)) if "{W}" in c else _with(c) for c in r]) for r in rows])
    listed = F.array(*[F.struct(F.lit(s).alias("strategy"), F.lit(i).alias("table_idx"), cells(rows).alias("cells")) for s, i, rows in TABLES])
    return docs.where("kind = 1").select("doc_id", F.lit(2).alias("page_num"), F.explode(listed).alias("t")).select("doc_id", "page_num", "t.*")


def word_boxes(docs: DataFrame) -> DataFrame:
    """Words of kind 5's second page, a line under the other, in two halves of the page."""
    line = lambda text, row, at: F.transform(F.split(_with(text), " "), lambda x, i: F.struct(x.alias("text"), (i * 60 + at).cast("int").alias("left"), F.lit(30 * row).alias("top")))
    words = F.concat(*[line(x, row, at) for side, at in ((LEFT, 10), (RIGHT, 510)) for row, x in enumerate(side)])
    box = [F.lit(n).alias(c) for c, n in (("width", 50), ("height", 12), ("conf", 90))]
    return docs.where("kind = 5").select("doc_id", F.lit(2).alias("page_num"), F.lit(1000).alias("page_width"), F.explode(words).alias("b")).select("doc_id", "page_num", "page_width", "b.*", *box)


def failures(docs: DataFrame) -> DataFrame:
    return docs.where("kind = 11").select("doc_id", F.lit("SyntaxError: no PDF").alias("error"), F.lit(None).cast("string").alias("traceback"))
