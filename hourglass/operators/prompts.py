"""Text prompts and model answers.

Entity text blocks are one ``groupBy(id)`` (first non-missing statics, min/max per dynamic feature)
rendered with ``format_number`` (JDK DecimalFormat: round-half-even on the exact binary value, the same
digits Python's ``:.2f`` prints) and ``concat_ws`` (NULL lines skipped). The model call is an injected
client run by ``mapInPandas`` (one client per partition, up to 3 tries per prompt, NULL on failure).
Answers are parsed with built-in regex/JSON expressions.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.session import cut_lineage
from hourglass.spec import PanelSpec

# ----------------------------------------------------------------------------------------------------
# Prompt templates, line formats and answer vocabularies (must match the reference text).
# Placeholders: {static_block}, {dynamic_block}, {examples}.
# ----------------------------------------------------------------------------------------------------
BINARY_INTRO = ("You are a clinical decision support system. Based on the following ICU patient data, "
                "predict whether the patient survived or died during their hospital stay.")
SCALE_INTRO = ("You are a clinical decision support system. Based on the following ICU patient data, "
               "estimate the patient's risk of in-hospital mortality.")
BINARY_INSTRUCTIONS = """## Instructions
- Analyze the provided clinical data carefully.
- Predict whether this patient is "alive" or "dead" at hospital discharge.
- Respond ONLY with a valid JSON object in exactly this format:
  {"prediction": "alive"} or {"prediction": "dead"}
- Do not include any explanation or additional text."""
SCALE_INSTRUCTIONS = """## Instructions
- Analyze the provided clinical data carefully.
- Output an integer from 1 to 10:
  - 1 = very confident the patient is alive at hospital discharge
  - 10 = very confident the patient is dead at hospital discharge
  - 5 or 6 = uncertain / borderline
- Respond ONLY with a valid JSON object in exactly this format:
  {"prediction": 7}
- Do not include any explanation or additional text."""
ZERO_SHOT_BODY = """

## Patient Information
{static_block}

## Time-Series Measurements (min and max over ICU stay)
{dynamic_block}

"""
FEW_SHOT_BODY = """

## Examples
{examples}

## Now predict for this patient:

### Patient Information
{static_block}

### Time-Series Measurements (min and max over ICU stay)
{dynamic_block}

"""
EXAMPLE_BLOCK = """### Example
Patient Information:
{static_block}

Time-Series Measurements:
{dynamic_block}

Prediction: {prediction}
"""
NO_STATIC = "  (no static data available)"
NO_DYNAMIC = "  (no dynamic data available)"
DYNAMIC_LINE = "  - {name}: min={min}, max={max}"  # min/max with 2 decimals
BINARY_TARGETS = {1: "dead", 0: "alive"}
SCALE_TARGETS = {1: 9, 0: 2}
BINARY_ANSWERS = ("alive", "dead")
SCALE_RANGE = (1, 10)
DEAD_THRESHOLD = 6
ICU_STATIC_LINES = (
    # (feature, kind, label, decimals, unit, yes/no words)
    ("Age", "number", "Age", 0, " years", None),
    ("Gender", "binary", "Gender", None, "", ("Male", "Female")),
    ("Height", "number", "Height", 1, " cm", None),
    ("Weight_static", "number", "Weight (admission)", 1, " kg", None),
)
ICU_FLAG_LINES = (("MechVent", "  - Mechanical Ventilation: Yes"),)
# ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PromptSpec:
    """How statics and flags are verbalised. ``static_lines``: (feature, 'number'|'binary', label,
    decimals, unit, (word if 1, word otherwise)); ``flag_lines``: (feature, line shown when max = 1)."""
    static_lines: tuple = ICU_STATIC_LINES
    flag_lines: tuple = ICU_FLAG_LINES


def fmt(x, decimals: int):
    """Fixed-point text with round-half-even on the exact value (no grouping separators)."""
    return F.regexp_replace(F.format_number(x, decimals), ",", "")


def patient_blocks(panel: DataFrame, spec: PanelSpec, pspec: PromptSpec) -> DataFrame:
    """L1: ``(id, static_block, dynamic_block[, label])`` — statics from the first non-missing row in time,
    flag lines when the feature's max is 1, then ``name: min=…, max=…`` per observed dynamic feature.
    """
    t = F.col(spec.time_col)
    aggs = []
    for feat, *_ in pspec.static_lines:
        aggs.append(F.min_by(feat, F.when(F.col(feat).isNotNull(), t)).alias(f"_s_{feat}"))
    for feat, _ in pspec.flag_lines:
        aggs.append(F.max(feat).alias(f"_f_{feat}"))
    flagged = {f for f, _ in pspec.flag_lines}
    dyn = [c for c in spec.dynamic if c not in flagged]
    for c in dyn:
        aggs += [F.min(c).alias(f"_mn_{c}"), F.max(c).alias(f"_mx_{c}")]
    if spec.target_col in panel.columns:
        aggs.append(F.min_by(spec.target_col, t).alias(spec.target_col))
    g = panel.groupBy(spec.id_col).agg(*aggs)

    s_lines = []
    for feat, kind, label, dec, unit, words in pspec.static_lines:
        v = F.col(f"_s_{feat}")
        text = (F.when(v == 1, F.lit(words[0])).otherwise(F.lit(words[1])) if kind == "binary"
                else F.concat(fmt(v, dec), F.lit(unit)))
        s_lines.append(F.when(v.isNotNull(), F.concat(F.lit(f"  - {label}: "), text)))
    for feat, line in pspec.flag_lines:
        s_lines.append(F.when(F.col(f"_f_{feat}") == 1, F.lit(line)))
    d_lines = [F.when(F.col(f"_mn_{c}").isNotNull(),
                      F.concat(F.lit(f"  - {c}: min="), fmt(F.col(f"_mn_{c}"), 2), F.lit(", max="),
                               fmt(F.col(f"_mx_{c}"), 2))) for c in dyn]
    sb = F.concat_ws("\n", *s_lines) if s_lines else F.lit("")
    db = F.concat_ws("\n", *d_lines) if d_lines else F.lit("")
    out = [spec.id_col, F.when(sb == "", F.lit(NO_STATIC)).otherwise(sb).alias("static_block"),
           F.when(db == "", F.lit(NO_DYNAMIC)).otherwise(db).alias("dynamic_block")]
    if spec.target_col in panel.columns:
        out.append(spec.target_col)
    return g.select(*out)


def _fill(template: str, **cols):
    """Template → concat of literal pieces and columns (placeholders are ``{name}``)."""
    parts, rest = [], template
    while "{" in rest:
        i = rest.index("{")
        j = rest.index("}", i)
        name = rest[i + 1:j]
        if name not in cols:
            parts.append(F.lit(rest[:j + 1]))
            rest = rest[j + 1:]
            continue
        parts.append(F.lit(rest[:i]))
        parts.append(cols[name])
        rest = rest[j + 1:]
    parts.append(F.lit(rest))
    return F.concat(*parts)


def _mode_parts(mode: str):
    if mode == "binary":
        return BINARY_INTRO, BINARY_INSTRUCTIONS
    if mode == "scale":
        return SCALE_INTRO, SCALE_INSTRUCTIONS
    raise ValueError(f"Unsupported prediction_mode: {mode}")


def zero_shot_prompt(blocks: DataFrame, mode: str = "binary") -> DataFrame:
    """L2: zero-shot prompt column; an unknown mode is an error."""
    intro, instr = _mode_parts(mode)
    p = _fill(intro + ZERO_SHOT_BODY + instr, static_block=F.col("static_block"), dynamic_block=F.col("dynamic_block"))
    return blocks.withColumn("prompt", p)


def few_shot_examples(blocks: DataFrame, label_col: str = "label", n_per_class: int = 3, seed: int = 42,
                      mode: str = "binary", id_col: str = "id") -> DataFrame:
    """L3: one row ``examples`` — n_per_class labelled examples per class in order [1, 0] (P4 draw), each
    rendered as an example block with its target answer, joined by newlines. Bounded by 2·n_per_class.
    """
    from hourglass.operators.sampling import stratified

    _mode_parts(mode)
    pick = stratified(blocks, label_col, n_per_class, (1, 0), seed, id_col)
    from hourglass.functions.exprs import draw_rank

    targets = BINARY_TARGETS if mode == "binary" else SCALE_TARGETS
    tgt = F.when(F.col(label_col) == 1, F.lit(targets[1])).otherwise(F.lit(targets[0])).cast("string")
    pred = (F.concat(F.lit('{"prediction": "'), tgt, F.lit('"}')) if mode == "binary"
            else F.concat(F.lit('{"prediction": '), tgt, F.lit("}")))
    text = _fill(EXAMPLE_BLOCK, static_block=F.col("static_block"), dynamic_block=F.col("dynamic_block"),
                 prediction=pred)
    rows = pick.select(F.struct("class_order", draw_rank(seed, "class", id_col).alias("h"), F.col(id_col).alias("i"),
                                text.alias("t")).alias("e"))
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["t"]), "\n")
                    .alias("examples"))


def few_shot_prompt(blocks: DataFrame, examples: str, mode: str = "binary") -> DataFrame:
    """L4: few-shot prompt; the examples text (bounded, see L3) is inlined as a literal."""
    intro, instr = _mode_parts(mode)
    p = _fill(intro + FEW_SHOT_BODY + instr, static_block=F.col("static_block"),
              dynamic_block=F.col("dynamic_block"), examples=F.lit(examples))
    return blocks.withColumn("prompt", p)


# ------------------------------------------------------------------ L5–L7: answers
def answer_json(text) -> F.Column:
    """The first ``{…}`` (non-greedy, dot matches newline) in the stripped text, else the whole text."""
    raw = F.trim(text)
    m = F.regexp_extract(raw, r"(?s)\{.*?\}", 0)
    return F.when(m != "", m).otherwise(raw)


def parse_binary(text) -> F.Column:
    """L5 + L6: 'alive' / 'dead' (trimmed, lower-cased JSON string field ``prediction``) or NULL."""
    j = answer_json(text)
    val = F.get_json_object(j, "$.prediction")
    is_str = j.rlike(r'"prediction"\s*:\s*"')
    v = F.lower(F.trim(val))
    return F.when(is_str & v.isin(*BINARY_ANSWERS), v)


def parse_scale(text) -> F.Column:
    """L5 + L7: integer 1..10 from a JSON number or a digit string, else NULL."""
    j = answer_json(text)
    val = F.get_json_object(j, "$.prediction")
    is_str = j.rlike(r'"prediction"\s*:\s*"')
    s = F.trim(val)
    as_int = F.when(is_str & s.rlike(r"^[0-9]+$"), s.try_cast("int")).when(
        ~is_str & val.rlike(r"^-?[0-9]+(\.0+)?$"), val.try_cast("double").try_cast("int"))
    lo, hi = SCALE_RANGE
    return F.when(as_int.between(lo, hi), as_int)


# ------------------------------------------------------------------ L8: model call
def valid_answer(text: str | None, mode: str) -> bool:
    """Whether a raw answer holds a usable prediction (the row-side twin of L5–L7, for the retry loop). Any text has
    a verdict: numbers beyond the range, NaN, infinities and deep nesting are no predictions."""
    raw = (text or "").strip()
    found = re.search(r"\{.*?\}", raw, re.S)
    try:
        value = json.loads(found[0] if found else raw)["prediction"]
    except (ValueError, KeyError, TypeError, RecursionError):
        return False
    if mode == "binary":
        return isinstance(value, str) and value.strip().lower() in BINARY_ANSWERS
    lo, hi = SCALE_RANGE
    if isinstance(value, str):
        digits = value.strip()
        if not re.fullmatch(r"[0-9]+", digits):
            return False
        digits = digits.lstrip("0") or "0"
        return len(digits) <= len(str(hi)) and lo <= int(digits) <= hi
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return False
    return lo <= value <= hi and value == int(value)


def ask(client, prompt: str, mode: str, retries: int) -> str | None:
    """The client's answer after up to ``retries`` tries: a call that raises, an answer that is no text and one that
    does not parse are tried again. The last text, or None if no call returned one."""
    text = None
    for _ in range(retries):
        try:
            got = client(prompt)
            text = got if isinstance(got, str) else text
            if isinstance(got, str) and valid_answer(got, mode):
                break
        except Exception:  # noqa: BLE001 - a failed call is retried, then NULL
            continue
    return text


def call_model(prompts: DataFrame, client_factory, id_col: str = "id", label_col: str | None = "label",
               retries: int = 3, mode: str = "binary") -> DataFrame:
    """Per-row model call through an injected client (``client_factory() → callable(prompt) → text``),
    up to ``retries`` tries: a call that raises and an answer that does not parse are both retried. The
    parsed answer (L5–L7) or NULL; id and label are kept.
    """
    keep = [id_col] + ([label_col] if label_col else [])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prompts.select(*keep).schema.fields) \
        + ", response string"
    parse = parse_binary if mode == "binary" else parse_scale

    def run(batches):
        client = client_factory()
        for pdf in batches:
            out = [ask(client, p, mode, retries) for p in pdf["prompt"]]
            res = pdf[keep].copy()
            res["response"] = pd.Series(out, dtype=object)
            yield res

    answered = prompts.select(*keep, "prompt").mapInPandas(run, schema)
    return answered.withColumn("prediction", parse(F.col("response")))


def rule_client_factory(mode: str = "binary"):
    """Deterministic stand-in client for tests and the registered queries: answers from prompt content,
    including malformed replies, so every parse and failure path runs."""
    def factory():
        def client(prompt: str) -> str:
            if "Segment: Building" in prompt:
                return 'Sure. {"prediction": " Dead "} hope this helps' if mode == "binary" else '{"prediction": "9"}'
            if "  - error: " in prompt:
                return '{"prediction": "alive"}' if mode == "binary" else '{"prediction": 3}'
            return "no json here" if mode == "binary" else '{"prediction": 11}'
        return client
    return factory


def evaluate_answers(answers: DataFrame, label_col: str = "label", mode: str = "binary",
                     threshold: int = DEAD_THRESHOLD) -> DataFrame:
    """L9 tail: M10 (failures count as wrong) then M8 / M9, plus ``failed`` and ``n``.

    The answers are written to the shared checkpoint folder first, so a model behind them is called once
    per row and every metric is computed from the same answers.
    """
    from hourglass.functions import metrics

    answers = cut_lineage(answers.select(label_col, "prediction"))
    if mode == "binary":
        d = answers.select(label_col, F.when(F.col("prediction") == "dead", 1).when(
            F.col("prediction") == "alive", 0).alias("pred"))
        d = metrics.fail_as_wrong(d, "pred", label_col, "binary")
        m = metrics.binary_metrics(d, "pred", label_col)
    else:
        d = answers.select(label_col, F.col("prediction").alias("score"))
        d = metrics.fail_as_wrong(d, "score", label_col, "scale")
        m = metrics.scale_metrics(d, "score", label_col, threshold)
    c = d.agg(F.sum(F.col("failed").cast("long")).alias("failed"), F.count(F.lit(1)).alias("n_answers")).first()
    return m.withColumn("failed", F.lit(int(c["failed"] or 0)).cast("long")) \
        .withColumn("n_answers", F.lit(int(c["n_answers"])).cast("long"))
