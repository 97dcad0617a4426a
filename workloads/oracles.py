"""DuckDB equivalents of the queries."""

from __future__ import annotations

from .views import oracle_views

# Code points that Python's str.isspace() accepts.
BLANKS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233]
BLANKS += [8239, 8287, 12288]
_BLANKS = f"concat({', '.join(f'chr({c})' for c in BLANKS)})"


def strip(x: str) -> str:
    return f"trim({x}, {_BLANKS})"


def timecode(x: str) -> str:
    s = f"cast(floor({x}) as bigint)"
    return f"printf('%02d:%02d:%02d', {s} // 3600, ({s} % 3600) // 60, {s} % 60)"


def words(x: str) -> str:
    return f"list_distinct([w for w in string_split_regex(lower({x}), '\\s+') if w <> ''])"


def similarity(x: str, y: str) -> str:
    a, b = words(x), words(y)
    both = f"len(list_intersect({a}, {b}))"
    return (
        f"case when len({a}) = 0 or len({b}) = 0 then 0e0 "
        f"else {both}::double / (len({a}) + len({b}) - {both}) end"
    )


def segments(videos: str, seconds: int) -> str:
    """Fixed-interval segments of a videos view, with number and title."""
    return f"""
select video_id, title, i + 1 as number, i * {seconds}e0 as start_time,
       least(i * {seconds}e0 + {seconds}e0, duration) as end_time
from (select *, unnest(range(cast(ceil(duration / {seconds}) as bigint) + 1)) as i from {videos})
where i * {seconds}e0 < duration"""


SEGMENT_TEXT = (
    "concat('Transcript segment ', number, ' from ', "
    + timecode("start_time")
    + ", ' to ', "
    + timecode("end_time")
    + ", ' of video ', title)"
)


def consecutive(seconds: int) -> str:
    return f"""
with {oracle_views('v_videos')}, cut as ({segments('v_videos', seconds)})
select video_id, start_time, end_time, end_time - start_time as duration,
       {SEGMENT_TEXT} as text, {timecode('start_time')} as timestamp
from cut"""


def packed(view: str, seconds: int) -> str:
    """Further common table expressions that end in ``packed``."""
    return f"""
items as (select *, row_number() over (partition by video_id order by seq) as i from {view}),
walk as (
  select video_id, i, case when start >= {seconds} then start else 0e0 end as anchor
  from items where i = 1
  union all
  select n.video_id, n.i, case when n.start - w.anchor >= {seconds} then n.start else w.anchor end
  from walk w join items n on n.video_id = w.video_id and n.i = w.i + 1),
grouped as (
  select video_id, anchor, string_agg(text, ' ' order by i) as joined,
         max_by(start + coalesce(duration, 0e0), i) as tail
  from walk join items using (video_id, i) group by video_id, anchor),
bounded as (
  select *, coalesce(lead(anchor) over (partition by video_id order by anchor), tail) as end_time
  from grouped),
packed as (
  select video_id, anchor as start_time, end_time, end_time - anchor as duration,
         {strip('joined')} as text, {timecode('anchor')} as timestamp
  from bounded where {strip('joined')} <> '')"""


def packing(view: str, seconds: int, select: str = "select * from packed", also: str = "") -> str:
    views = oracle_views(*([also] if also else []), view)
    return f"with recursive {views}, {packed(view, seconds)} {select}"


def youtube_id(x: str) -> str:
    return (
        f"coalesce(nullif(regexp_extract({x}, "
        r"'(?:youtube\.com/watch\?v=|youtu\.be/|youtube\.com/embed/)([^&\n?#]+)', 1), ''), "
        f"nullif(regexp_extract({x}, " + r"'youtube\.com/watch\?.*v=([^&\n?#]+)', 1), ''))"
    )


def parsed(response: str) -> str:
    """Question and answer of a tagged response, null where missing or empty."""

    def tagged(tag: str) -> str:
        lines = f"[{strip('l')} for l in string_split({response}, chr(10))]"
        last = f"([l for l in {lines} if starts_with(l, '{tag}')])[-1]"
        return f"nullif({strip(f'''replace({last}, '{tag}', '')''')}, '')"

    return f"{tagged('Question:')} as q, {tagged('Answer:')} as a"


PARSED = f"parsed as (select *, {parsed('response')} from v_responses)"

SUFFIX = r"'[^/]\.(mp4|avi|mov|mkv|webm|flv|wmv)$'"
STEM = r"regexp_replace(split_part(path, '/', -1), '^(.+)\.[^.]+$', '\1')"

_STREAMS = "json_extract(probe, '$.streams')"
PROBE = f"""
probed as (
  select *, ([s for s in cast({_STREAMS} as json[]) if s->>'$.codec_type' = 'video'])[1] as stream,
         try_cast(probe->>'$.format.duration' as double) as duration
  from v_probe)"""

# labelled pairs, see labelled_pairs() in queries.py
PAIRS = f"""
{oracle_views('v_answers')},
split_pairs as (
  select *, {parsed('response')}, cast(conv_id as varchar) as video_id, turn * 12.5e0 as start_time,
         case when substring(md5(cast(conv_id as varchar)), 1, 4) < 'cccc' then 'training'
              else 'validation' end as split
  from v_answers),
pairs as (
  select split, q as question, a as answer, answer as transcript,
         concat('Conversation ', video_id) as video_ref, {timecode('start_time')} as timecode,
         video_id, start_time, start_time + 12.5e0 as end_time,
         {similarity('answer_without_context', 'a')} > 0.7 as is_answerable_without_context,
         {similarity('answer_with_context', 'a')} > 0.7 as is_answerable_with_context,
         case split when 'training' then 'writer-a' else 'writer-b' end as llm_s_model,
         case split when 'training' then 'reader-a' else 'reader-b' end as llm_a_model,
         {similarity('answer_with_context', 'a')} as confidence_score
  from split_pairs where q is not null and a is not null)"""

# every fifth conversation in a third split
PAIRS_OF_THREE = (
    PAIRS.replace("case when substring(md5(", "case when conv_id % 5 = 0 then 'test' when substring(md5(")
    .replace("case split when 'training' then 'w", "case split when 'test' then 'writer-c' when 'training' then 'w")
    .replace("case split when 'training' then 'r", "case split when 'test' then 'reader-c' when 'training' then 'r")
)

FLAT = """select split, question, answer, transcript, video_ref, timecode, video_id, start_time,
       end_time, is_answerable_without_context, is_answerable_with_context, llm_s_model, llm_a_model
from pairs"""

STATS = """
stats as (
  select split, coalesce(n, 0) as qa_pairs, coalesce(wo, 0) as answerable_without_context,
         coalesce(wo::double / nullif(n, 0), 0e0) as answerable_without_context_ratio,
         coalesce(wi, 0) as answerable_with_context,
         coalesce(wi::double / nullif(n, 0), 0e0) as answerable_with_context_ratio,
         llm_s_model, llm_a_model
  from (values ('training','writer-a','reader-a'), ('validation','writer-b','reader-b'),
               ('unused','writer-c','reader-c')) as config(split, llm_s_model, llm_a_model)
  left join (select split, count(*) as n, count(*) filter (is_answerable_without_context) as wo,
                    count(*) filter (is_answerable_with_context) as wi
             from pairs group by split) using (split))"""

_REPORT = [
    ("qa_pairs", "cast({s}.qa_pairs as varchar)"),
    ("answerable_without_context", "cast({s}.answerable_without_context as varchar)"),
    ("answerable_without_context_ratio", "printf('%.3f', {s}.answerable_without_context_ratio)"),
    ("answerable_with_context", "cast({s}.answerable_with_context as varchar)"),
    ("answerable_with_context_ratio", "printf('%.3f', {s}.answerable_with_context_ratio)"),
    ("llm_s_model", "{s}.llm_s_model"),
    ("llm_a_model", "{s}.llm_a_model"),
]
REPORT = " union all ".join(
    f"select {i} as line, '{m}' as metric, {v.format(s='t')} as training, {v.format(s='v')} as validation"
    " from (select * from stats where split = 'training') t,"
    " (select * from stats where split = 'validation') v"
    for i, (m, v) in enumerate(_REPORT, 1)
)

REPORT_OF_THREE = " union all ".join(
    f"select {i} as line, '{m}' as metric, {v.format(s='t')} as training, {v.format(s='v')} as validation,"
    f" {v.format(s='u')} as test"
    " from (select * from stats where split = 'training') t,"
    " (select * from stats where split = 'validation') v, (select * from stats where split = 'test') u"
    for i, (m, v) in enumerate(_REPORT, 1)
)

QUESTION = "What is discussed in this transcript segment?"
TEMPLATE_PAIRS = f"""
{oracle_views('v_videos')}, cut as ({segments('v_videos', 30)}),
texts as (select *, {SEGMENT_TEXT} as transcript from cut),
made as (
  select *, '{QUESTION}' as question,
         concat('This segment discusses: ', substring(transcript, 1, 100), '...') as answer,
         concat('Based on the context: ', substring(transcript, 1, 50),
                '... The answer is related to the provided transcript.') as open_answer,
         'General knowledge answer for: {QUESTION}' as closed_answer
  from texts),
config(split, llm_s_model, llm_a_model) as (
  values ('training','placeholder-llm-s','placeholder-llm-a'),
         ('validation','placeholder-writer','placeholder-reader')),
template_pairs as (
  select split, question, answer, transcript, title as video_ref,
         {timecode('start_time')} as timecode, video_id, start_time, end_time,
         {similarity('closed_answer', 'answer')} > 0.7 as is_answerable_without_context,
         {similarity('open_answer', 'answer')} > 0.7 as is_answerable_with_context,
         llm_s_model, llm_a_model, open_answer, closed_answer
  from made, config)"""

_DOC = "try_cast(json_extract(document, '{p}') as bigint)"


def _number(path: str) -> str:
    return f"cast(coalesce({_DOC.format(p=path)}, 0) as varchar)"


def _text(path: str, default: str) -> str:
    return f"coalesce(json_extract_string(document, '{path}'), '{default}')"


_ANALYSIS = [
    ("total_videos", _number("$.total_videos")),
    ("total_segments", _number("$.total_segments")),
    ("total_qa_pairs", _number("$.total_qa_pairs")),
    *[
        line
        for side in ("training", "validation")
        for line in (
            (
                f"{side}_qa_pairs",
                f"cast(coalesce(json_array_length(document, '$.{side}_split.qa_pairs'), 0) as varchar)",
            ),
            (f"{side}_llm_s_model", _text(f"$.{side}_split.llm_s_model", "Unknown")),
            (f"{side}_llm_a_model", _text(f"$.{side}_split.llm_a_model", "Unknown")),
        )
    ],
    ("created_at", _text("$.created_at", "Unknown")),
    ("description", _text("$.description", "No description")),
]
ANALYSIS = " union all ".join(
    f"select {_text('$.name', 'Unknown')} as dataset, {i} as line, '{m}' as metric, {v} as value from v_stored"
    for i, (m, v) in enumerate(_ANALYSIS, 1)
)

# Prompt texts, see segqa/functions/prompts.py
SYNTHESIS = (
    "concat('Read this passage of a video transcript and write one natural, specific question that"
    " the passage answers, with a short and direct answer.', chr(10), chr(10), 'Transcript: ', {t},"
    " chr(10), chr(10), 'Reply with exactly these two lines:', chr(10), 'Question: <question>',"
    " chr(10), 'Answer: <answer>')"
)
CLOSED = (
    "concat('Answer this question from general knowledge.{rule}', chr(10), chr(10), 'Question: ',"
    " {q}, chr(10), chr(10), 'Give a concise answer.')"
)
STRICT = " Do not assume any particular context."
OPEN = (
    "concat('Answer the question from the context alone.', chr(10), chr(10), 'Context: ', {c},"
    " chr(10), chr(10), 'Question: ', {q}, chr(10), chr(10),"
    " 'Give a concise answer that uses nothing but the context.')"
)

_TOTALS = f"""
cut as ({segments('v_videos', 30)}),
totals as (select (select count(*) from v_videos) as total_videos, (select count(*) from cut) as total_segments,
                  (select count(*) from pairs) as total_qa_pairs)"""


def document_report(name: str, models: dict[str, str]) -> str:
    """The report of a document whose splits have models ending in the letters of ``models``."""
    metrics = [(f"{m}", f"(select {m} from totals)") for m in ("total_videos", "total_segments", "total_qa_pairs")]
    for split, letter in models.items():
        metrics += [
            (f"{split}_qa_pairs", f"(select count(*) from pairs where split = '{split}')"),
            (f"{split}_llm_s_model", f"'writer-{letter}'"),
            (f"{split}_llm_a_model", f"'reader-{letter}'"),
        ]
    metrics += [("created_at", None), ("description", f"""'"{name}" splits'""")]
    return " union all ".join(
        f"select '{name}' as dataset, {i} as line, '{m}' as metric, cast({v} as varchar) as value"
        for i, (m, v) in enumerate(metrics, 1)
        if v
    )


ORACLES = {
    "consecutive_segments": consecutive(30),
    "consecutive_segments_long": consecutive(7),
    "timecodes": f"""
with {oracle_views('v_videos')}
select video_id, {timecode('duration')} as timecode, {timecode('duration * 1000')} as long_timecode
from v_videos""",
    "packed_captions": packing("v_captions", 30),
    "packed_captions_chunked": packing("v_captions", 30),
    "packed_events": packing("v_event_captions", 86_400),
    "external_segments": f"""
with {oracle_views('v_captions')}
select video_id, start as start_time, start + duration as end_time, duration, text,
       {timecode('start')} as timestamp
from v_captions""",
    "segments_fallback": packing(
        "v_captions",
        30,
        f""", cut as ({segments("""(
  select * from v_videos where cast(video_id as bigint) % 10 <> 3 and video_id not in (
    select video_id from v_captions where cast(video_id as bigint) % 4 <> 0))""", 30)})
select * from packed where cast(video_id as bigint) % 4 <> 0 union all
select video_id, start_time, end_time, end_time - start_time, {SEGMENT_TEXT}, {timecode('start_time')}
from cut""",
        "v_videos",
    ),
    "extracted_segments": packing(
        "v_captions",
        30,
        f""", cut as ({segments('(select * from v_videos where video_id not in (select video_id from v_captions))', 30)})
select packed.*, title as video_ref from packed join v_videos using (video_id) union all
select video_id, start_time, end_time, end_time - start_time, {SEGMENT_TEXT}, {timecode('start_time')}, title
from cut""",
        "v_videos",
    ),
    "implausible_videos": f"""
with {oracle_views('v_videos')}
select video_id, 'implausible duration' as error from v_videos
where cast(video_id as bigint) % 5 in (1, 2)
   or cast(video_id as bigint) % 5 = 0 and duration * 1e12 > 1e10""",
    "caption_join": packing(
        "v_captions",
        30,
        f"""select u.video_id, p.start_time, p.end_time, p.duration, p.text, p.timestamp
from v_urls u join packed p on p.video_id = {youtube_id('u.url')}""",
        "v_urls",
    ),
    "exploded_captions": """
select cast(doc_id as varchar) as video_id, i as seq, i * 2.5e0 as start,
       case when i % 3 <> 2 then i * 0.5e0 end as duration, lines[i + 1] as text
from (select doc_id, lines, unnest(range(len(lines))) as i
      from (select doc_id, string_split(text, chr(10)) as lines from documents))""",
    "unmatched_urls": f"""
with {oracle_views('v_urls', 'v_captions')},
keyed as (select video_id, url, {youtube_id('url')} as id from v_urls)
select video_id, url, case when id is null then 'no platform id' else 'no captions' end as reason
from keyed where id is null or id not in (select video_id from v_captions)""",
    "titled_segments": packing(
        "v_captions",
        30,
        "select packed.*, coalesce(title, 'Unknown Video') as video_ref"
        " from packed left join v_videos using (video_id)",
        "v_videos",
    ),
    "video_paths": f"""
with {oracle_views('v_paths')}
select page_id, path, sha256(path) as video_id, {STEM} as title,
       concat('/out/videos/', sha256(path), '.mp4') as file_path
from v_paths where regexp_matches(lower(path), {SUFFIX})""",
    "scanned_videos": f"""
with {oracle_views('v_files')}
select path, length from v_files where regexp_matches(lower(path), {SUFFIX})""",
    "probe_metadata": f"""
with {oracle_views('v_probe')}, {PROBE}
select video_id, duration, try_cast(stream->>'$.width' as integer) as width,
       try_cast(stream->>'$.height' as integer) as height
from probed where stream is not null and duration is not null""",
    "processed_videos": f"""
with {oracle_views('v_probe', 'v_paths')}, {PROBE}
select sha256(path) as video_id, {STEM} as title, duration,
       concat('/out/', sha256(path), '.mp4') as file_path
from v_paths join probed on probed.video_id = cast(page_id as varchar)
where regexp_matches(lower(path), {SUFFIX}) and stream is not null and duration is not null""",
    "youtube_ids": f"""
with {oracle_views('v_urls')} select page_id, {youtube_id('url')} as youtube_id from v_urls""",
    "quarantined_rows": f"""
with {oracle_views('v_probe')}, {PROBE}
select video_id, case when stream is null then 'no video stream' else 'bad duration' end as error
from probed where stream is null or duration is null""",
    "parse_qa": f"""
with {oracle_views('v_responses')}, {PARSED}
select conv_id, turn, q as question, a as answer from parsed where q is not null and a is not null""",
    "parse_qa_fields": f"""
with {oracle_views('v_responses')}, {PARSED}
select conv_id, turn, case when a is not null then q end as question,
       case when q is not null then a end as answer
from parsed""",
    "text_functions": f"""
select doc_id, length({strip("concat(' ', chr(9), chr(10), text, chr(13), chr(10), ' ')")}) as stripped,
       regexp_matches(lower(text), 'what|when|where|who|how|why') as has_question_word,
       doc_id % 2 = 0 as is_placeholder,
       len({words('text')}) as words
from documents""",
    "answer_similarity": f"""
with {oracle_views('v_answers')}
select conv_id, turn, {similarity('answer_with_context', 'answer')} as with_context,
       {similarity('answer_without_context', 'answer')} as without_context
from v_answers""",
    "answerability_flags": f"""
with {oracle_views('v_answers')}
select conv_id, turn, {similarity('answer_with_context', 'answer')} > 0.7 as with_context,
       {similarity('answer_without_context', 'answer')} > 0.7 as without_context
from v_answers""",
    "placeholder_pairs": f"""
with {TEMPLATE_PAIRS} select * exclude (open_answer, closed_answer) from template_pairs""",
    "caption_pairs": packing(
        "v_captions",
        30,
        f""", made as (
  select *, coalesce(title, 'Unknown Video') as video_ref,
         concat('This segment discusses: ', substring(text, 1, 100), '...') as answer,
         concat('Based on the context: ', substring(text, 1, 50),
                '... The answer is related to the provided transcript.') as answer_with_context,
         'General knowledge answer for: {QUESTION}' as answer_without_context
  from packed left join v_videos using (video_id))
select split, video_id, start_time, video_ref, answer, answer_with_context, answer_without_context,
       {similarity('answer_with_context', 'answer')} > 0.7 as is_answerable_with_context,
       {similarity('answer_without_context', 'answer')} > 0.7 as is_answerable_without_context
from made, (values ('training'), ('validation')) as s(split)""",
        "v_videos",
    ),
    "prompt_columns": f"""
with {oracle_views('v_responses')}, {PARSED}
select conv_id, turn, {SYNTHESIS.format(t='answer')} as synthesis,
       {CLOSED.format(q='q', rule=STRICT)} as closed_book,
       {CLOSED.format(q='q', rule='')} as closed_book_again,
       {OPEN.format(q='q', c='answer')} as open_book
from parsed where q is not null and a is not null and answer <> ''""",
    "prompt_dedup": f"""
with {oracle_views('v_videos')}, prompts as (
  select {CLOSED.format(q=f"'{QUESTION}'", rule=STRICT)} as prompt from v_videos
  union
  select {SYNTHESIS.format(t=r"regexp_extract(title, '^(.*)-[^-]*$', 1)")} from v_videos)
select 'reader' as model, sha256(prompt) as prompt_hash, prompt from prompts""",
    "flat_pairs": f"with {PAIRS} {FLAT}",
    "validated_pairs": f"""
with {TEMPLATE_PAIRS}
select split, video_id, start_time, is_answerable_without_context,
       {similarity('open_answer', 'answer')} as context_similarity,
       {similarity('closed_answer', 'answer')} as no_context_similarity
from template_pairs""",
    "context_dependent": f"""
with {PAIRS}
select video_id, start_time, question from pairs where not is_answerable_without_context""",
    "min_confidence": f"""
with {PAIRS}
select video_id, start_time, confidence_score from pairs where confidence_score >= 0.7""",
    "expanded_splits": f"""
with {oracle_views('v_videos')}
select video_id, split, llm_s_model, llm_a_model from v_videos,
  (values ('training','placeholder-llm-s','placeholder-llm-a'),
          ('validation','placeholder-writer','placeholder-reader')) as c(split, llm_s_model, llm_a_model)""",
    "ratio_split": f"""
with {oracle_views('v_videos')}
select video_id, case when substring(md5(video_id), 1, 4) < 'cccc' then 'training'
                      else 'validation' end as split
from v_videos""",
    "split_stats": f"with {PAIRS}, {STATS} select * from stats",
    "stats_report": f"with {PAIRS}, {STATS} {REPORT}",
    "third_split": f"""
with {PAIRS_OF_THREE}, {STATS.replace("'unused'", "'test'")} {REPORT_OF_THREE}""",
    "dataset_totals": f"""
with {TEMPLATE_PAIRS}
select (select count(*) from v_videos) as total_videos, (select count(*) from cut) as total_segments,
       (select count(*) from template_pairs) as total_qa_pairs""",
    "dataset_info": f"""
with {PAIRS}, {oracle_views('v_videos')}, cut as ({segments('v_videos', 30)})
select 'set' as name, 'from tables' as description, '{{"segment_duration": 30}}' as config,
       (select count(*) from v_videos) as total_videos, (select count(*) from cut) as total_segments,
       (select count(*) from pairs) as total_qa_pairs,
       (select count(*) from pairs where split = 'training') as training_qa_pairs,
       (select count(*) from pairs where split = 'validation') as validation_qa_pairs""",
    "info_roundtrip": f"""
with {PAIRS_OF_THREE}, {oracle_views('v_videos')}, cut as ({segments('v_videos', 30)})
select 'set' as name, 'from tables' as description,
       (select count(*) from v_videos) as total_videos, (select count(*) from cut) as total_segments,
       (select count(*) from pairs) as total_qa_pairs,
       (select count(*) from pairs where split = 'training') as training_qa_pairs,
       (select count(*) from pairs where split = 'validation') as validation_qa_pairs,
       (select count(*) from pairs where split = 'test') as test_qa_pairs""",
    "analyze_dataset": f"with {oracle_views('v_stored')} {ANALYSIS}",
    "dataset_pairs": f"""
with {oracle_views('v_stored')},
sides as (
  select json_extract_string(document, '$.name') as dataset, split,
         cast(json_extract(document, '$.' || split || '_split.qa_pairs') as json[]) as qa_pairs
  from v_stored, (values ('training'), ('validation')) as s(split)),
single as (select dataset, split, unnest(qa_pairs) as pair from sides)
select dataset, split, pair->>'$.question' as question, pair->>'$.answer' as answer from single""",
    "nested_splits": f"""
with {PAIRS}
select split as name, llm_s_model, llm_a_model, video_id,
       cast(floor(start_time / 30720) as bigint) as block, list(question order by start_time) as questions,
       true as dated
from pairs group by all""",
    "infer_batch": f"""
with {oracle_views('v_responses')}, prompts as (
  select distinct answer, {OPEN.format(q="'What is said here?'", c='answer')} as prompt
  from v_responses)
select sha256(prompt) as prompt_hash,
       array_to_string([w for w in string_split_regex(answer, '\\s+') if w <> ''], ' ') as response,
       cast(null as varchar) as error
from prompts""",
    "failed_calls": f"""
with {oracle_views('v_responses')}, prompts as (
  select distinct {OPEN.format(q="'What is said here?'", c='answer')} as prompt from v_responses)
select 'open_book' as call, 'reader' as model, count(*) as requests,
       count(*) filter (length(prompt) % 3 = 0) as failed,
       case when count(*) filter (length(prompt) % 3 = 0) > 0 then 'no response' end as example
from prompts""",
    "resumed_calls": f"""
with {oracle_views('v_responses')}, prompts as (
  select distinct {OPEN.format(q="'What is said here?'", c='answer')} as prompt from v_responses)
select sha256(prompt) as prompt_hash, concat('answer to ', length(prompt)) as response,
       cast(null as varchar) as error, 1::bigint as answers
from prompts""",
    "request_settings": f"""
with {oracle_views('v_responses')}
select conv_id, turn, 'reader 0.7 300' as first, 'reader 0.3 150' as second from v_responses""",
    "validated_pairs_called": packing(
        "v_captions",
        30,
        f""", called as (
  select *, array_to_string([w for w in string_split_regex(text, '\\s+') if w <> ''], ' ') as answer
  from packed)
select video_id, start_time, {similarity("'unknown'", 'answer')} > 0.7 as is_answerable_without_context,
       {similarity('answer', 'answer')} as context_similarity,
       {similarity("'unknown'", 'answer')} as no_context_similarity
from called""",
    ),
    "built_dataset": packing(
        "v_captions",
        30,
        f""", cut as ({segments('(select * from v_videos where video_id not in (select video_id from v_captions))', 30)}),
all_segments as (
  select video_id, start_time, end_time, text, title from packed join v_videos using (video_id)
  union all select video_id, start_time, end_time, {SEGMENT_TEXT}, title from cut)
select split, video_id, start_time, end_time, title as video_ref, text as transcript,
       '{QUESTION}' as question
from all_segments, (values ('training'), ('validation')) as s(split)""",
        "v_videos",
    ),
    "build_report": packing(
        "v_captions",
        30,
        f""", odd as (
  select * replace (case cast(video_id as bigint) % 7 when 0 then 'inf'::double when 1 then null
    when 2 then 0e0 else duration end as duration) from v_videos),
cut as ({segments("(select * from odd where duration <= 1e10 and video_id not in (select video_id from v_captions))", 30)}),
lines as (
  select cast(video_id as bigint) % 3 = 0 or {strip('joined')} = '' as blank from bounded
  where video_id in (select video_id from odd where duration <= 1e10)
  union all select false from cut)
select 'videos' as stage, unnest(['read', 'no duration', 'implausible duration', 'no length']) as reason,
  unnest([count(*), count(*) filter (duration is null), count(*) filter (duration > 1e10),
    count(*) filter (duration <= 0)]) as rows from odd
union all
select 'segments', unnest(['read', 'blank']), unnest([count(*), count(*) filter (blank)]) from lines""",
        "v_videos",
    ),
    "late_captions": f"""
with {oracle_views('v_captions')},
evens as (select video_id, max(seq) as last from v_captions where seq % 2 = 0 group by video_id)
select c.video_id, c.seq, c.start, (c.start + coalesce(c.duration, 0e0)) - c.start as duration,
       {strip('c.text')} as text
from v_captions c join evens e on c.video_id = e.video_id where c.seq % 2 = 1 and c.seq < e.last""",
    "validated_rows": """
select doc_id as row, case when error is null then n_chars end as length,
       case when error is null then source end as source,
       case when error is null then case when doc_id % 4 = 0 then 2 else 1 end end::integer as passes, error
from (select *, case when doc_id % 6 = 0 then 'length: not bigint'
                     when doc_id % 7 = 0 or source is null then 'source: missing' end as error
      from documents)""",
    "provider_pairs": packing(
        "v_captions",
        30,
        f""", called as (
  select *, array_to_string([w for w in string_split_regex(text, '\\s+') if w <> ''], ' ') as answer,
         concat('This segment discusses: ', substring(text, 1, 100), '...') as template,
         concat('Based on the context: ', substring(text, 1, 50),
                '... The answer is related to the provided transcript.') as open_answer,
         'General knowledge answer for: {QUESTION}' as closed_answer
  from packed)
select 'training' as split, video_id, start_time, 'What is said here?' as question,
       'reader' as llm_a_model, {similarity("'unknown'", 'answer')} > 0.7 as is_answerable_without_context,
       true as is_answerable_with_context
from called
union all
select 'validation', video_id, start_time, '{QUESTION}', 'placeholder-llm-a',
       {similarity('closed_answer', 'template')} > 0.7, {similarity('open_answer', 'template')} > 0.7
from called""",
    ),
    "flat_roundtrip": f"with {PAIRS} {FLAT}",
    "splits_roundtrip": f"with {PAIRS} {FLAT}",
    "document_roundtrip": f"with {PAIRS_OF_THREE} {FLAT}",
    "analyzed_documents": f"""
select * from (with {PAIRS_OF_THREE}, {oracle_views('v_videos')}, {_TOTALS}
{document_report('three', {'training': 'a', 'validation': 'b', 'test': 'c'})})
union all
select * from (with {PAIRS}, {oracle_views('v_videos')}, {_TOTALS}
{document_report('two', {'training': 'a', 'validation': 'b'})})""",
    "document_lines": f"with {PAIRS} select question, video_id from pairs",
    "stream_pairs": f"""
with {TEMPLATE_PAIRS} select * exclude (open_answer, closed_answer) from template_pairs""",
    "stream_pairs_called": packing(
        "v_captions",
        30,
        f""", called as (
  select *, array_to_string([w for w in string_split_regex(text, '\\s+') if w <> ''], ' ') as answer
  from packed)
select 'training' as split, video_id, start_time, 'What is said here?' as question,
       {similarity("'unknown'", 'answer')} > 0.7 as is_answerable_without_context,
       true as is_answerable_with_context
from called""",
    ),
    "stream_segments": packing("v_captions", 30),
    "stream_split_stats": f"""
with {PAIRS}
select split, count(*) as qa_pairs,
       count(*) filter (is_answerable_without_context) as answerable_without_context,
       count(*) filter (is_answerable_with_context) as answerable_with_context
from pairs group by split""",
}
