"""Inputs of the engine derived from the test tables.

Each view is one SQL text that both engines run; ``$table`` stands for a table. Only the event
captions differ: Spark numbers them without ordering all events of a user in one task.
"""

from __future__ import annotations

from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TABLES = ("documents", "conversations", "pages", "benchmark", "events")

VIEWS = {
    "v_videos": """
select cast(doc_id as string) video_id, concat(lang,'-',source,'-',cast(doc_id as string)) title,
       n_chars/10e0 duration, concat('/lake/',cast(doc_id as string),'.mp4') file_path
from $documents""",
    "v_paths": """
select page_id, concat('/lake/',cast(page_id % 7 as string),'/clip',cast(page_id as string),
       case page_id % 10 when 0 then '.mp4' when 1 then '.AVI' when 2 then '.mov' when 3 then '.Mkv'
         when 4 then '.webm' when 5 then '.flv' when 6 then '.wmv' when 7 then '.txt'
         when 8 then '.mp4.bak' else '' end) path
from $pages""",
    # files below a folder, some of them or of their folders under names that other readers skip
    "v_files": """
select page_id, concat(cast(page_id % 7 as string),
       case page_id % 5 when 0 then '/.cache/' when 1 then '/_new/' else '/' end,
       case page_id % 4 when 0 then '.' when 1 then '_' else '' end,'clip 100%',cast(page_id as string),
       case page_id % 11 when 0 then '.mp4' when 1 then '.AVI' when 2 then '.mov' when 3 then '.Mkv'
         when 4 then '.webm' when 5 then '.flv' when 6 then '.wmv' when 7 then '.txt'
         when 8 then '.mp4.bak' when 9 then '.mp4' else '' end) path, page_id % 100 length
from $pages""",
    "v_probe": """
select cast(doc_id as string) video_id, concat('{"streams":[',
       case doc_id % 4 when 0 then '' else '{"codec_type":"audio"}' end,
       case when doc_id % 4 in (1,2) then ',' else '' end,
       case doc_id % 4 when 3 then '' else '{"codec_type":"video","width":1280,"height":720}' end,
       '],"format":{"duration":"',
       case doc_id % 9 when 8 then 'N/A' else cast(n_chars as string) end, '.5"}}') probe
from $documents""",
    "v_urls": """
select page_id, cast(page_id as string) video_id, case page_id % 6
       when 0 then concat('https://www.youtube.com/watch?v=',cast(page_id as string),'&t=3')
       when 1 then concat('https://youtu.be/',cast(page_id as string),'?t=1')
       when 2 then concat('https://youtube.com/embed/',cast(page_id as string),'#f')
       when 3 then concat('https://youtube.com/watch?list=1&v=a&v=',cast(page_id as string))
       when 4 then 'https://youtube.com/watch?v=' else url end url
from $pages""",
    "v_captions": """
select cast(conv_id as string) video_id, turn seq, turn*12.5e0 start,
       case when turn % 3 = 2 then cast(null as double) else 12.5e0 end duration,
       case when turn % 5 = 4 then ' ' else text end text
from $conversations""",
    "v_responses": """
select u.conv_id, u.turn, a.text answer, case u.conv_id % 5
       when 4 then concat('Question: ',replace(u.text,chr(10),' '))
       when 3 then concat('Question: x',chr(10),'Question: ',replace(u.text,chr(10),' '),chr(13),chr(10),
                          'Answer: Answer: ',replace(a.text,chr(10),' '))
       else concat('  Question: ',replace(u.text,chr(10),' '),chr(10),
                   '  Answer: ',replace(a.text,chr(10),' '),'  ') end response
from $conversations u join $conversations a on a.conv_id=u.conv_id and a.turn=u.turn+1
where u.role='user' and a.role='assistant'""",
    "v_answers": """
select r.conv_id, r.turn, r.response, r.answer, b.item_id,
       substring(r.answer,1,cast(floor(length(r.answer)*0.85e0) as int)) answer_with_context,
       case r.conv_id % 3 when 0 then substring(r.answer,1,cast(floor(length(r.answer)*0.9e0) as int))
         when 1 then '' else coalesce(b.text,'') end answer_without_context
from (select *, (conv_id * 31 + turn) % (select count(*) from $benchmark) item from $v_responses) r
left join $benchmark b on b.item_id = r.item""",
    # stored dataset documents, some with absent parts
    "v_stored": """
select doc_id, concat('{"total_videos":',cast(doc_id % 7 as string),',"total_segments":',cast(n_chars as string),
       case doc_id % 3 when 0 then '' else concat(',"name":"set-',cast(doc_id as string),'"') end,
       case doc_id % 4 when 0 then '' else ',"description":"from documents","total_qa_pairs":3' end,
       case doc_id % 5 when 0 then '' else concat(',"training_split":{"name":"training","llm_s_model":"writer-',lang,
         '","llm_a_model":"reader","qa_pairs":[{"question":"q1","answer":"a1"},{"question":"q2","answer":"a2"}]}') end,
       case doc_id % 6 when 0 then '' else concat(',"validation_split":{"llm_a_model":"',source,
         '","qa_pairs":[{"question":"q3","answer":"a3"}]}') end, '}') document
from $documents""",
}

# DuckDB's form of the event captions.
EVENT_CAPTIONS = """
select cast(user_id as string) video_id,
       cast(row_number() over (partition by user_id order by ts,event_id)-1 as bigint) seq,
       (epoch_us(ts) - min(epoch_us(ts)) over (partition by user_id))/1e6 start,
       value duration, concat(event_type,cast(event_id as string)) text
from events"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(spark_text(sf_dir, name))


def spark_text(sf_dir: str, name: str) -> str:
    tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    if name == "v_answers":
        tables["v_responses"] = f"({spark_text(sf_dir, 'v_responses')})"
    return Template(VIEWS[name]).substitute(tables)


def oracle_views(*names: str) -> str:
    """The views as leading common table expressions of a DuckDB query."""
    same = {t: t for t in (*TABLES, "v_responses")}
    texts = {n: Template(VIEWS[n]).substitute(same) for n in VIEWS}
    texts["v_event_captions"] = EVENT_CAPTIONS
    wanted = ["v_responses", *names] if "v_answers" in names else list(names)
    return ", ".join(f"{n} as ({texts[n]})" for n in dict.fromkeys(wanted))


def event_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as captions of one video per user, numbered in time order.

    A user may hold a large share of all events. Each minute of a user is numbered on its own and
    shifted by the events of the minutes before, so no task sorts all events of a user; the shifts
    of a user are at most one row per minute.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("video_id"),
        F.floor(micros / 60_000_000).alias("minute"),
        micros.alias("us"),
        "event_id",
        F.col("value").alias("duration"),
        F.concat("event_type", F.col("event_id").cast("string")).alias("text"),
    )
    by_minute = W.partitionBy("video_id").orderBy("minute")
    shifts = (
        events.groupBy("video_id", "minute")
        .agg(F.count("*").alias("n"), F.min("us").alias("first_us"))
        .select(
            "video_id",
            "minute",
            (F.sum("n").over(by_minute) - F.col("n")).alias("before"),
            F.first("first_us").over(by_minute).alias("origin_us"),
        )
    )
    number = F.row_number().over(W.partitionBy("video_id", "minute").orderBy("us", "event_id"))
    return events.join(shifts, ["video_id", "minute"]).select(
        "video_id",
        (F.col("before") + number - 1).alias("seq"),
        ((F.col("us") - F.col("origin_us")) / F.lit(1e6)).alias("start"),
        "duration",
        "text",
    )


def long_event_videos(spark: SparkSession, sf_dir: str, chunk_rows: int) -> DataFrame:
    """Users with more events than fit in a chunk."""
    counts = table(spark, sf_dir, "events").groupBy("user_id").count()
    return counts.filter(F.col("count") > chunk_rows).select(
        F.col("user_id").cast("string").alias("video_id")
    )
