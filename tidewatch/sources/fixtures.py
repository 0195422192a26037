"""Raw (bronze) tables derived from the driver's test tables.

The test tables hold no market data, so the three raw record sets are
derived from ``events`` (prices, macro series) and ``documents`` (news).
The SQL is written once and is portable: Spark runs it with the test tables
bound as DataFrames, and the DuckDB oracle runs the same text on its views.
The raw tables keep the JSON shape (string dates and timestamps) and carry
deliberate dirt: duplicate ingestions, a malformed date, null prices, null
titles, duplicate URLs, gaps in the macro series and days without news.

News records use the whole document text as the headline, so scoring and
every later step process whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Each CTE is (name, body). Placeholders {events} / {documents} name the
# source tables; Spark binds DataFrames, the oracle binds view names. {twice}
# gives a row two copies, numbered 0 and 1, so that a table with re-ingested
# rows reads its source once.
FIXTURE_CTES: list[tuple[str, str]] = [
    (
        "px",
        """
  select 'T' || lpad(cast(user_id as string), cast(greatest(6, length(cast(user_id as string))) as int), '0') as ticker,
         -- no trading on days 9, 10, 20 and 21: what happened then counts on the next trading day
         cast(ts as date) + cast(case extract(day from ts) when 9 then 2 when 10 then 1 when 20 then 2 when 21 then 1
                                      else 0 end as int) as d, event_id, value,
         cast(1000000 + (case when event_type in ('click','view') then 2
                              when event_type = 'purchase' then 1
                              else -2 end) * cast(round(value * 100) as bigint) as double) / 10000 as price
  from {events}""",
    ),
    (
        "bars",
        """
  select ticker, d, min_by(price, event_id) as open, max(price) as high,
         min(price) as low, max_by(price, event_id) as close,
         cast(sum(cast(round(value * 100) as bigint)) as bigint) as volume
  from px
  group by ticker, d""",
    ),
    (
        "raw_stocks",
        """
  select ticker, case when again = 1 and day = 5 then 'n/a' else cast(d as string) end as date, open, high, low,
         case when again = 0 or day = 5 then close
              when day % 7 = 0 then close + 0.25
              else cast(null as double) end as close,
         volume, 'synthetic' as source,
         case when again = 0 or day = 5 then '2024-02-01T06:00:00.000001'
              when day % 7 = 0 then '2024-02-02T06:00:00.000001'
              else '2024-02-03T06:00:00.000001' end as ingested_at
  from (select *, extract(day from d) as day, {twice} as again from bars) b
  where again = 0 or day % 7 = 0 or day in (5, 11)""",
    ),
    (
        # Every text is a headline; some documents come once more without one.
        "titled",
        """
  select doc_id, 0 as again, source, text as title,
         'https://news.example/' || cast(doc_id - (case when doc_id % 10 = 9 then 1 else 0 end) as string) as url
  from {documents}
  union all
  select doc_id, 1, source, cast(null as string), 'https://news.example/' || cast(doc_id as string) || '/untitled'
  from {documents} where doc_id % 97 = 0""",
    ),
    (
        "raw_news",
        """
  select title, cast(null as string) as description, source as source_name, url,
         cast(date '2024-01-01' + cast(
           case when doc_id % 50 = 0 then 20 + cast(floor(doc_id / 50) as int) % 7
                when doc_id % 50 in (1, 2) then 15 + cast(floor(doc_id / 50) as int) % 5
                else ((doc_id % 14) * (doc_id % 14)) % 14 end as int) as string) || 'T09:00:00Z' as published_at,
         cast(null as string) as content_snippet,
         'query ' || cast(doc_id % 20 as string) as search_query,
         'synthetic' as source,
         case when doc_id % 10 = 9 then '2024-02-01T07:00:00.000001'
              else '2024-02-01T06:00:00.000001' end as ingested_at
  from titled""",
    ),
    (
        "ev",
        """
  select event_type, d0 + cast(dd - d0_day as int) as d, dd,
         cast(sum(cast(round(value * 100) as bigint)) as double) / count(*) as a
  from (
    -- series have no observation on some days: what happened then counts on a day that has one
    select event_type, value, d0, d0_day,
           case event_type
                when 'click' then least(day, 29)
                when 'view' then least(greatest(day, 3), 26)
                       - (case least(greatest(day, 3), 26) % 7 when 6 then 1 when 0 then 2 else 0 end)
                when 'purchase' then day - (case day % 7 when 6 then 1 when 0 then 2 else 0 end)
                when 'error' then day - (1 - day % 2)
                when 'signup' then (case when day <= 11 then 2 else 12 end)
                else day end as dd
    from (select event_type, value, cast(ts as date) as d0, extract(day from ts) as d0_day,
                 case extract(day from ts) when 16 then 15 when 30 then 29 else extract(day from ts) end as day
          from {events}) e) m
  group by event_type, d0 + cast(dd - d0_day as int), dd""",
    ),
    (
        "macro",
        """
  select series_id,
         case series_id when 'DFF' then 'federal_funds_rate' when 'VIXCLS' then 'vix_volatility_index'
                        when 'T10Y2Y' then 'treasury_yield_spread' when 'DGS10' then '10y_treasury_yield'
                        when 'UNRATE' then 'unemployment_rate' else 'consumer_price_index' end as series_name,
         case when series_id in ('UNRATE', 'CPIAUCSL') then 'monthly' else 'daily' end as frequency,
         d,
         cast(floor(case series_id when 'DFF' then a * 7 when 'VIXCLS' then a * 2 * (12 + (dd % 8) * 3)
                                   when 'T10Y2Y' then a when 'DGS10' then a * 8 when 'UNRATE' then a * 8
                                   else a * 600 end) as bigint) as v
  from (select *,
               case when event_type = 'click' then 'DFF' when event_type = 'view' then 'VIXCLS'
                    when event_type = 'purchase' then 'T10Y2Y' when event_type = 'error' then 'DGS10'
                    when event_type = 'signup' and dd = 2 then 'UNRATE'
                    when event_type = 'signup' then 'CPIAUCSL' end as series_id
        from ev) t
  where series_id is not null""",
    ),
    (
        "raw_macro",
        """
  select series_id, series_name, cast(d as string) as date, cast(v + 100 * again as double) / 10000 as value,
         frequency, 'synthetic' as source,
         case when again = 0 then '2024-02-01T06:00:00.000001' else '2024-02-02T06:00:00.000001' end as ingested_at
  from (select *, {twice} as again from macro) m
  where again = 0 or extract(day from d) % 9 = 0""",
    ),
]

# Landed source payloads, before they are shaped into raw records.
PAYLOAD_CTES: list[tuple[str, str]] = [
    (
        "price_history",
        """
  select 'T' || lpad(cast(user_id as string), cast(greatest(6, length(cast(user_id as string))) as int), '0') as ticker,
         cast(cast(ts as date) as timestamp) as day_ts,
         90 + min_by(value, event_id) / 7 as open_px,
         90 + max(value) / 7 as high_px,
         90 + min(value) / 7 as low_px,
         90 + max_by(value, event_id) / 7 as close_px,
         -- exact in binary (integer sum + 0.25), so truncation agrees across engines
         cast(sum(cast(round(value * 1000) as bigint)) as double) + 0.25 as volume_raw
  from {events}
  group by 'T' || lpad(cast(user_id as string), cast(greatest(6, length(cast(user_id as string))) as int), '0'), cast(cast(ts as date) as timestamp)""",
    ),
    (
        "news_articles",
        """
  select doc_id % 20 as query_pos, cast(floor(doc_id / 200) as bigint) as page, doc_id * 2 + again as article_key,
         title, cast(null as string) as description, cast(null as string) as content,
         case when doc_id % 13 = 0 then cast(null as string) else url end as url,
         cast(date '2024-01-01' + cast(((doc_id % 28) * (doc_id % 28)) % 28 as int) as string) || 'T08:30:00Z' as published_at,
         source as source_name
  from titled""",
    ),
    (
        "macro_days",
        """
  select series_id, obs_date, avg(value) / 3 as value
  from (select case event_type when 'click' then 'DFF' when 'view' then 'VIXCLS'
                               when 'purchase' then 'T10Y2Y' when 'error' then 'DGS10'
                               else 'UNRATE' end as series_id,
               cast(ts as date) as obs_date, value
        from {events}) o
  group by series_id, obs_date""",
    ),
    (
        "macro_obs",
        """
  select series_id, obs_date, value from macro_days
  union all
  -- days on which an empty observation was sent as well
  select series_id, obs_date, cast('NaN' as double) from macro_days where extract(day from obs_date) % 11 = 0""",
    ),
]

SOURCE_TABLES = ("events", "documents")


def cte_text(names: list[str] | None = None) -> str:
    """The ``WITH``-list body (no leading WITH) for the given fixture CTEs."""
    every = FIXTURE_CTES + PAYLOAD_CTES
    chosen = every if names is None else [c for c in every if c[0] in names]
    return ",\n".join(f"{name} as ({body}\n)" for name, body in chosen)


def _deps(target: str) -> list[str]:
    order = [n for n, _ in FIXTURE_CTES + PAYLOAD_CTES]
    bodies = dict(FIXTURE_CTES + PAYLOAD_CTES)
    need = {target}
    for name in reversed(order):
        if name in need:
            need |= {o for o in order if o != name and _mentions(bodies[name], o)}
    return [n for n in order if n in need]


def _mentions(body: str, name: str) -> bool:
    import re

    return re.search(rf"\b(from|join)\s+{name}\b", body) is not None


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``raw_stocks``, ``raw_news``, ``raw_macro`` from the test tables."""
    deps = _deps(name)
    text = f"with {cte_text(deps)}\nselect * from {name}".replace("{twice}", "explode(array(0, 1))")
    bound = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **bound)


def raw_stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_table(spark, sf_dir, "raw_stocks")


def raw_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_table(spark, sf_dir, "raw_news")


def raw_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_table(spark, sf_dir, "raw_macro")


def news_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News search responses: one row per (query, page) with up to ten articles.

    Shaped like the search API's JSON: ``articles`` is an array of structs
    with a nested ``source.name``. A page holds the documents of one residue
    class in a block of 200 ids (ten, and the few that come again untitled),
    so its size is bounded by construction.
    """
    from pyspark.sql import functions as F

    flat = raw_table(spark, sf_dir, "news_articles")
    article = F.struct(
        F.col("article_key"), F.col("title"), F.col("description"), F.col("content"), F.col("url"),
        F.col("published_at").alias("publishedAt"), F.struct(F.col("source_name").alias("name")).alias("source"),
    )
    grouped = flat.groupBy("query_pos", "page").agg(F.sort_array(F.collect_list(article)).alias("_a"))
    return grouped.select(
        "query_pos", "page",
        F.transform("_a", lambda a: a.dropFields("article_key")).alias("articles"),
    )


def oracle_ctes() -> list[tuple[str, str]]:
    """Fixture CTEs with DuckDB view names bound."""
    return [(n, b.format(events="events", documents="documents", twice="unnest([0, 1])")) for n, b in FIXTURE_CTES + PAYLOAD_CTES]
