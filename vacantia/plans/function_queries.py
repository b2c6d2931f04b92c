"""Queries over the scalar functions themselves, on whole texts and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions import text, urls
from vacantia.plans.catalog import query
from vacantia.plans.oracle import fold, word_text


@query(
    "fn1_tokenise",
    f"""SELECT doc_id, len(w) AS n, md5(array_to_string(w, ' ')) AS words FROM (SELECT doc_id,
      list_filter(regexp_split_to_array({fold('text')}, '[^a-z0-9+#]+'), lambda x: x <> '') AS w
      FROM documents)""",
)
def _(d):
    docs = d.table("documents")
    ws = docs.select("doc_id", text.words(F.col("text")).alias("w"))
    return ws.select(
        "doc_id", F.size("w").cast("long").alias("n"), F.md5(F.array_join("w", " ")).alias("words")
    )


@query(
    "fn1_word_text",
    f"SELECT conv_id, turn, md5({word_text('text')}) AS words FROM conversations",
)
def _(d):
    turns = d.table("conversations")
    return turns.select("conv_id", "turn", F.md5(text.word_text(F.col("text"))).alias("words"))


@query(
    "fn4_link_parts",
    """SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host,
      regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page,
      regexp_extract(url, '[?&]ref=([^&#]*)', 1) AS ref FROM pages""",
)
def _(d):
    url = F.col("url")
    return d.table("pages").select(
        "page_id", urls.host(url).alias("host"), urls.query_param(url, "page").alias("page"),
        urls.query_param(url, "ref").alias("ref"),
    )
