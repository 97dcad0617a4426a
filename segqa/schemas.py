"""Fixed schemas of every table and document; nothing is ever inferred."""

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


_S, _D, _L, _I, _B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()

VIDEO = _struct(video_id=_S, title=_S, duration=_D, file_path=_S, source_url=_S)
ENTRY = _struct(path=_S, length=_L, folder=_B)
CAPTION = _struct(video_id=_S, seq=_L, start=_D, duration=_D, text=_S)
CAPTION_ITEM = _struct(start=_D, duration=_D, text=_S)
SEGMENT = _struct(video_id=_S, start_time=_D, end_time=_D, duration=_D, text=_S, timestamp=_S)
EXTERNAL_SEGMENT = _struct(video_id=_S, start_time=_D, duration=_D, text=_S, timestamp=_S)
SOURCE_DOCUMENT = _struct(
    transcript=_S, video_ref=_S, timecode=_S, video_id=_S, start_time=_D, end_time=_D
)
QA_PAIR = _struct(
    question=_S,
    answer=_S,
    source_document=SOURCE_DOCUMENT,
    llm_s_model=_S,
    llm_a_model=_S,
    is_answerable_without_context=_B,
    is_answerable_with_context=_B,
)
# What absent fields of a video and of a pair stand for.
VIDEO_DEFAULTS = {"source_url": None}
PAIR_DEFAULTS = {"is_answerable_without_context": False, "is_answerable_with_context": True}
SPLIT_PAIR = T.StructType([T.StructField("split", _S, True), *QA_PAIR.fields])
FLAT_PAIR = _struct(
    question=_S,
    answer=_S,
    transcript=_S,
    video_ref=_S,
    timecode=_S,
    video_id=_S,
    start_time=_D,
    end_time=_D,
    is_answerable_without_context=_B,
    is_answerable_with_context=_B,
    llm_s_model=_S,
    llm_a_model=_S,
)
SPLIT_DOCUMENT = _struct(
    name=_S, qa_pairs=T.ArrayType(QA_PAIR), llm_s_model=_S, llm_a_model=_S, created_at=_S
)
# `config` is kept as a string map: its keys differ between versions of saved documents.
DATASET = _struct(
    name=_S,
    description=_S,
    training_split=SPLIT_DOCUMENT,
    validation_split=SPLIT_DOCUMENT,
    config=T.MapType(_S, _S),
    created_at=_S,
    total_videos=_L,
    total_segments=_L,
    total_qa_pairs=_L,
)
# Probe numbers arrive as text or as numbers; both read as text and are cast afterwards.
PROBE = T.StructType(
    [
        T.StructField(
            "streams", T.ArrayType(_struct(codec_type=_S, width=_S, height=_S)), True
        ),
        T.StructField("format", _struct(duration=_S), True),
    ]
)
RESPONSE = _struct(request_id=_S, call=_S, model=_S, response=_S, error=_S)
