"""The full gate: one verdict per utterance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttergate.config import GateConfig
from uttergate.functions.metrics import with_text_metrics
from uttergate.functions.script import with_script
from uttergate.functions.template import staged, template
from uttergate.functions.text import is_blank, pin, safe_string, with_normalized_text
from uttergate.operators import gates
from uttergate.operators.audio import with_audio
from uttergate.operators.split import VERDICT, others
from uttergate.schema import MALFORMED, REQUIRED_COLUMNS


def require_columns(df: DataFrame) -> None:
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def verdict(
    df: DataFrame,
    config: GateConfig | None = None,
    audio_properties: DataFrame | None = None,
    unique_properties: bool = False,
    where: Column | str | None = None,
) -> DataFrame:
    """The utterance table with its verdict, a struct column named ``VERDICT``.

    Every input column stays as it is; a verdict from an earlier gate is replaced. ``where`` picks the rows to
    judge by input columns; it reaches the scan, which a filter behind the gate cannot.

    All reasons are kept, in gate order; only the audio gate is skipped once an earlier reason
    exists. A row that cannot be judged (a malformed record, an infinite flag) has its processing error as the one
    reason. The audio join comes before the text steps, so that what it shuffles is the raw
    row and not the derived columns as well.
    """
    config = config or GateConfig()
    require_columns(df)
    if where is not None:
        df = df.where(where)
    types = {f.name: f.dataType for f in df.schema.fields}
    inputs = others(df.columns, [VERDICT])

    known = tuple((n, types.get(n)) for n in (*REQUIRED_COLUMNS, "quality_flag", MALFORMED))
    df = staged(df, _early_steps(known))

    if config.check_audio:
        df = with_audio(
            df,
            audio_properties,
            config,
            path="_ug_path",
            eligible=F.size("_ug_early") == 0,
            spread_by=["_ug_id", "_ug_lang"],
            out="_ug_audio",
            unique=unique_properties,
        )
    else:
        df = with_audio(
            df, None, config, path="_ug_path", eligible=F.lit(False), out="_ug_audio"
        )

    df = staged(df, _row_steps(known, config))
    df = with_normalized_text(
        df, "_ug_text", "_ug_lang", config, out="_ug_norm", trace="_ug_trace"
    )
    df = with_script(df, "_ug_norm", "_ug_lang", out="_ug_script")
    # A step that the engine interprets ends a stage of generated code; one stage of all that follows the script would
    # be too long for the JVM to compile.
    df = staged(df, _audio_steps())
    # Behind the last Python step, across which the optimizer prunes no metrics that nobody asks for.
    df = with_text_metrics(
        df, "_ug_norm", out="_ug_metrics", single_spaced=config.normalize_punctuation
    )

    df = staged(df, _late_steps(known, config))
    return df.select(*inputs, VERDICT)


@template
def _early_steps(known: tuple) -> list[dict]:
    types = dict(known)
    texts = {
        out: safe_string(F.col(name), types[name])
        for out, name in (
            ("_ug_id", "utterance_id"),
            ("_ug_path", "audio_path"),
            ("_ug_lang", "language"),
            ("_ug_text", "transcription_raw"),
        )
    }
    return [texts, {"_ug_early": gates.reason_list(*gates.presence_reasons(*map(F.col, texts)))}]


@template
def _row_steps(known: tuple, config: GateConfig) -> list[dict]:
    """The late gates that don't need the normalised text. Behind it, with all the rest, they made the generated code
    too long for the JVM to compile."""
    types = dict(known)
    flag = gates.flag_reason(F.col("quality_flag"), types["quality_flag"]) if types["quality_flag"] else F.lit(None)
    steps = {
        "_ug_has_text": ~is_blank(F.col("_ug_text")),
        "_ug_r_duration": gates.duration_reason(F.col("duration_sec"), types["duration_sec"], config),
        "_ug_r_path": gates.path_reason(F.col("_ug_path"), F.col("_ug_lang"), config),
        "_ug_r_flag": flag.cast("string"),
    }
    return [{name: pin(step) for name, step in steps.items()}]


@template
def _audio_steps() -> list[dict]:
    issues = F.col("_ug_audio")["issues"]
    return [{"_ug_audio_reasons": pin(F.transform(issues, lambda i: F.concat(F.lit("audio_"), i)))}]


@template
def _late_steps(known: tuple, config: GateConfig) -> list[dict]:
    types, has_text = dict(known), F.col("_ug_has_text")
    late = [
        F.col("_ug_r_duration"),
        F.col("_ug_r_path"),
        *[F.when(has_text, r) for r in gates.text_reasons(F.col("_ug_metrics"), config)],
        F.when(has_text, gates.script_reason(F.col("_ug_script"))),
        F.col("_ug_r_flag"),
    ]
    errors = []
    if types[MALFORMED]:
        errors.append(F.when(F.col(MALFORMED).isNotNull(), gates.MALFORMED_ERROR))
    if types["quality_flag"]:
        flag, flag_type = F.col("quality_flag"), types["quality_flag"]
        if not isinstance(flag_type, T.IntegralType):
            errors.append(F.when(gates.flag_is_infinite(flag, flag_type), gates.INFINITE_FLAG_ERROR))
    error = F.coalesce(*errors) if errors else F.lit(None).cast("string")
    failed = error.isNotNull()
    reasons = F.when(failed, F.array(error)).otherwise(
        F.concat(F.col("_ug_early"), F.col("_ug_audio_reasons"), F.array_compact("_ug_late"))
    )
    parts = {
        "transcription_normalized": F.when(failed, "").otherwise(F.col("_ug_norm")),
        "text_metrics": F.when(has_text, F.col("_ug_metrics")),
        "script": F.when(has_text, F.col("_ug_script")),
    }
    # The verdict is made of columns alone, so that the optimizer drops the parts nobody asks for.
    pinned = {f"_ug_v_{name}": pin(part) for name, part in parts.items()}
    judged = F.struct(
        (F.size("_ug_reasons") == 0).alias("is_valid"),
        F.col("_ug_reasons").alias("reasons"),
        F.col("_ug_v_transcription_normalized").alias("transcription_normalized"),
        F.col("_ug_trace").alias("normalization"),
        F.col("_ug_v_text_metrics").alias("text_metrics"),
        F.col("_ug_v_script").alias("script"),
        F.col("_ug_audio").alias("audio"),
    )
    # The late gates have a step of their own, as array_compact would interpret them.
    return [{"_ug_late": pin(F.array(*late))}, {"_ug_reasons": pin(reasons)}, pinned, {VERDICT: judged}]
