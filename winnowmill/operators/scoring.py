"""Row scoring through a pluggable scorer, with retries and per-row error capture.

A scorer is a picklable callable ``(batch: pandas.DataFrame) -> pandas.DataFrame`` of equal length and
order. It reads the columns ``prompt`` (and ``response``, ``perplexity``, ``options`` where given) and
returns ``trustworthiness_score`` plus, when it answers prompts, ``response``; optionally
``perplexity``, ``explanation`` and ``custom_eval_criteria`` (a list of ``{"name", "score"}``).

Only the columns a scorer reads cross to Python; the rest of the row stays in the JVM. The scorer
expression is marked non-deterministic, so Spark evaluates it once per row of the plan. A repeated
task still calls the scorer again: write the result out before using it more than once.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import BadRequest, ConnectionFailed, InvalidInput, RateLimited, ScorerFailure, TimedOut
from ..functions.text import constrain_outputs
from ..functions.typing import in_unit_range

Scorer = Callable[[pd.DataFrame], pd.DataFrame]

ERROR_TYPE = "struct<message:string,retryable:boolean>"
LOG_TYPE = (
    "struct<perplexity:double,explanation:string,"
    f"custom_eval_criteria:array<struct<name:string,score:double>>,error:{ERROR_TYPE}>"
)
RESULT_TYPE = f"struct<response:string,trustworthiness_score:double,log:{LOG_TYPE}>"
_FLAT_TYPE = (
    "response string, trustworthiness_score double, perplexity double, explanation string, "
    "custom_eval_criteria array<struct<name:string,score:double>>, "
    "error_message string, error_retryable boolean, attempts int"
)
_FLAT_COLUMNS = [p.split()[0] for p in _FLAT_TYPE.split(", ")]
_FLAT_ARROW = [
    pa.field("response", pa.string()),
    pa.field("trustworthiness_score", pa.float64()),
    pa.field("perplexity", pa.float64()),
    pa.field("explanation", pa.string()),
    pa.field("custom_eval_criteria", pa.list_(pa.struct([("name", pa.string()), ("score", pa.float64())]))),
    pa.field("error_message", pa.string()),
    pa.field("error_retryable", pa.bool_()),
    pa.field("attempts", pa.int32()),
]
# Bytes of a batch that are rows of Python at once; a batch of short rows is one part.
SLICE_BYTES = 4 << 20

# Service limits in tokens, and characters counted per token.
MAX_PROMPT_TOKENS = 70_000
MAX_RESPONSE_TOKENS = 15_000
MAX_COMBINED_TOKENS = 70_000
CHARACTERS_PER_TOKEN = 4


@dataclass(frozen=True)
class RetryPolicy:
    """How often a failing row is tried again, and how long to wait in between (seconds).

    ``timeout`` bounds one call of the scorer, ``deadline`` all calls and waits for one batch; None is no
    bound. Waits for a scorer that cannot be reached or asks to wait are counted for the batch, not for each
    of its rows. A call beyond its time goes on in the background: after ``hung_calls`` of them the rest of
    the batch fails without a call. After ``alike`` single rows in a row that fail with the same message, a
    part of the batch that fails with it again is not halved: all its rows have failed.
    """

    retries: int = 3
    connection_retries: int = 20
    longest_wait: float = 60.0
    sleep: Callable[[float], None] = field(default=time.sleep)
    timeout: float | None = 600.0
    deadline: float | None = 7200.0
    clock: Callable[[], float] = field(default=time.monotonic)
    rate_limit_retries: int = 100
    hung_calls: int = 1000
    alike: int = 32


# The messages below are those that callers compare with.
def length_error(prompt: Column | str, response: Column | str | None = None, row: Column | str | None = None) -> Column:
    """Error struct for texts beyond the service limits (never worth a retry); null within them."""

    def as_column(c):
        return F.col(c) if isinstance(c, str) else c

    def tokens(c):
        return F.char_length(as_column(c)) / CHARACTERS_PER_TOKEN

    head = F.lit("") if row is None else F.concat(
        F.lit("Error executing query at index "), as_column(row).cast("string"), F.lit(": ")
    )
    limit = F.when(
        tokens(prompt) > MAX_PROMPT_TOKENS,
        F.concat(head, F.lit(f"Prompt length exceeds maximum length of {MAX_PROMPT_TOKENS} tokens")),
    )
    if response is not None:
        limit = limit.when(
            tokens(response) > MAX_RESPONSE_TOKENS,
            F.concat(head, F.lit(f"Response length exceeds maximum length of {MAX_RESPONSE_TOKENS} tokens")),
        ).when(
            tokens(prompt) + tokens(response) > MAX_COMBINED_TOKENS,
            F.concat(
                head,
                F.lit(
                    "Prompt and response combined length exceeds maximum combined length of "
                    f"{MAX_COMBINED_TOKENS} tokens"
                ),
            ),
        )
    return F.when(
        limit.isNotNull(), F.struct(limit.alias("message"), F.lit(False).alias("retryable"))
    )


def _call(scorer: Scorer, rows: pd.DataFrame, policy: RetryPolicy) -> pd.DataFrame:
    """The scorer's answer for these rows, within the time that the policy gives it."""
    if policy.timeout is None:
        out = scorer(rows)
    else:
        box: dict = {}

        def work() -> None:
            try:
                box["out"] = scorer(rows)
            except BaseException as e:
                box["error"] = e

        # A call that hangs cannot be ended from outside; a daemon thread does not keep the worker alive.
        thread = threading.Thread(target=work, daemon=True)
        thread.start()
        thread.join(policy.timeout)
        if "error" in box:
            raise box["error"]
        if "out" not in box:
            raise TimedOut(f"the scorer took longer than {policy.timeout} seconds")
        out = box["out"]
    if len(out) != len(rows):
        raise ScorerFailure("scorer returned a different number of rows", False)
    return out


class _Waits:
    """The connection failures in a row and the time used so far, for one batch."""

    def __init__(self, policy: RetryPolicy):
        self.policy, self.connection, self.limited, self.began = policy, 0, 0, policy.clock()
        self.hung, self.message, self.times = 0, None, 0

    def call(self, scorer: Scorer, rows: pd.DataFrame) -> pd.DataFrame:
        try:
            out = _call(scorer, rows, self.policy)
        except TimedOut:
            self.hung += 1
            raise
        self.connection = self.limited = 0
        self.message = None
        return out

    def failed(self, message: str) -> None:
        """Counts single rows that fail alike, one after the other."""
        self.times = self.times + 1 if message == self.message else 1
        self.message = message

    def hopeless(self, error: Exception) -> bool:
        return self.message == str(error) and self.times >= self.policy.alike

    def check(self) -> None:
        if self.hung >= self.policy.hung_calls:
            raise TimedOut(f"{self.hung} calls of the scorer did not end in time")
        if self.policy.deadline is not None and self.policy.clock() - self.began > self.policy.deadline:
            raise TimedOut(f"the batch took longer than {self.policy.deadline} seconds")

    def after(self, error: ScorerFailure) -> bool:
        """Waits as the error asks; False if there have been too many waits."""
        if isinstance(error, RateLimited):
            if self.limited >= self.policy.rate_limit_retries:
                return False
            self.limited += 1
            self.policy.sleep(error.retry_after)
            return True
        if self.connection >= self.policy.connection_retries:
            return False
        self.policy.sleep(min(2.0**self.connection, self.policy.longest_wait))
        self.connection += 1
        return True


def _scored_once(
    scorer: Scorer, row: pd.DataFrame, policy: RetryPolicy, waits: _Waits | None = None
) -> tuple[pd.Series | None, str, bool, int]:
    """One row, tried as often as the policy allows: (result, error message, retryable, attempts)."""
    waits = waits or _Waits(policy)
    general = attempts = 0
    while True:
        try:
            waits.check()
            attempts += 1
            out = waits.call(scorer, row)
            return out.iloc[0], "", False, attempts
        except BadRequest as e:
            return None, e.message, e.retryable, attempts
        except (RateLimited, ConnectionFailed) as e:
            if not waits.after(e):
                return None, e.message, True, attempts
        except Exception as e:
            if general >= policy.retries or attempts == 0:
                return None, str(e), getattr(e, "retryable", True), attempts
            policy.sleep(2.0**general)
            general += 1


def _run_batch(
    scorer: Scorer, batch: pd.DataFrame, capture: bool, policy: RetryPolicy, waits: _Waits | None = None
) -> pd.DataFrame:
    """Score a batch in one call; a part that fails is halved, so that one bad row costs few calls.

    While the scorer cannot be reached or asks to wait, the same part is tried again, not its rows one
    by one. Each row of the result has its number of calls as the part that settled it saw them.
    """
    waits, parts, open_ = waits or _Waits(policy), [], [(0, len(batch))]
    single: dict = {}  # rows settled one by one
    while open_:
        start, end = open_.pop()
        part = batch.iloc[start:end]
        if end - start > 1:
            try:
                waits.check()
                out = waits.call(scorer, part).reset_index(drop=True)
                out.index = part.index
                parts.append(out.assign(attempts=1))
                continue
            except (RateLimited, ConnectionFailed) as e:
                if waits.after(e):
                    open_.append((start, end))
                    continue
            except Exception as e:  # which row is to blame shows when a single one fails
                if waits.hopeless(e):
                    retryable = bool(getattr(e, "retryable", True))
                    if not capture:
                        raise ScorerFailure(str(e), retryable) from e
                    cells = {"error_message": str(e), "error_retryable": retryable, "attempts": 1}
                    parts.append(pd.DataFrame([cells] * len(part), index=part.index, dtype="object"))
                    continue
            middle = (start + end) // 2
            open_ += [(middle, end), (start, middle)]
            continue
        result, message, retryable, attempts = _scored_once(scorer, part, policy, waits)
        if result is None and not capture:
            raise ScorerFailure(message, retryable)
        cells = {} if result is None else result.to_dict()
        if result is None:
            waits.failed(message)
            cells |= {"error_message": message, "error_retryable": retryable}
        single[part.index[0]] = cells | {"attempts": attempts}
    if single:
        parts.append(pd.DataFrame(list(single.values()), index=list(single), dtype="object"))
    return pd.concat([p.astype("object") for p in parts]).loc[batch.index] if parts else pd.DataFrame(index=batch.index)


def slices(columns: Sequence[pa.Array], most: int = SLICE_BYTES) -> Iterator[list[pa.Array]]:
    """Runs of rows of parallel columns with about ``most`` bytes; at least a row each."""
    rows = len(columns[0])
    sizes = np.zeros(rows, np.int64)
    for c in columns:
        if pa.types.is_string(c.type) or pa.types.is_large_string(c.type):
            sizes += pc.fill_null(pc.binary_length(c), 0).to_numpy()
        elif rows:
            sizes += c.nbytes // rows
    ends, start = np.cumsum(sizes), 0
    while start < rows:
        end = max(start + 1, int(np.searchsorted(ends, most + (ends[start - 1] if start else 0), side="right")))
        yield [c.slice(start, end - start) for c in columns]
        start = end


def _scorer_expression(scorer: Scorer, names: list[str], capture: bool, policy: RetryPolicy):
    """Column function over ``active`` and the named inputs; inactive rows never reach the scorer.

    A batch becomes rows of Python in parts of SLICE_BYTES, which share the batch's waits and limits.
    """

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            waits = _Waits(policy)
            for active, *inputs in slices(columns):
                rows = pd.DataFrame({n: c.to_pandas() for n, c in zip(names, inputs)}, index=pd.RangeIndex(len(active)))
                chosen = rows[active.to_numpy(zero_copy_only=False).astype(bool)]
                out = pd.DataFrame(index=rows.index, columns=_FLAT_COLUMNS, dtype="object")
                if len(chosen):
                    scored = _run_batch(scorer, chosen, capture, policy, waits)
                    for name in _FLAT_COLUMNS:
                        if name in scored:
                            values = scored[name].astype("object")
                            plain = values.map(lambda v: None if isinstance(v, float) and v != v else v)
                            out.loc[chosen.index, name] = plain
                out["custom_eval_criteria"] = out["custom_eval_criteria"].map(_criteria)
                for name in ("trustworthiness_score", "perplexity"):
                    out[name] = pd.to_numeric(out[name])
                fields = [pa.array(out[f.name], f.type, from_pandas=True) for f in _FLAT_ARROW]
                yield pa.StructArray.from_arrays(fields, fields=list(_FLAT_ARROW))

    run.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, ...]],
        "return": Iterator[pa.Array],
    }
    return F.arrow_udf(run, returnType=_FLAT_TYPE).asNondeterministic()


def _criteria(value):
    if value is None or (isinstance(value, float) and value != value):
        return None
    return [{"name": str(c["name"]), "score": float(c["score"])} for c in value]


def _result(flat: Column, response: Column, error: Column) -> Column:
    """The nested result of a row from the scorer's flat output and an error found beforehand."""
    failed = F.coalesce(
        error.cast(ERROR_TYPE),
        F.when(
            flat["error_message"].isNotNull(),
            F.struct(flat["error_message"].alias("message"), flat["error_retryable"].alias("retryable")),
        ),
    )
    return F.struct(
        F.when(failed.isNull(), response).alias("response"),
        F.when(failed.isNull(), flat["trustworthiness_score"]).alias("trustworthiness_score"),
        F.struct(
            flat["perplexity"].alias("perplexity"),
            flat["explanation"].alias("explanation"),
            flat["custom_eval_criteria"].alias("custom_eval_criteria"),
            failed.alias("error"),
        ).alias("log"),
    ).cast(RESULT_TYPE)


def _check_text(df: DataFrame, *columns: str) -> None:
    for c in columns:
        if c not in df.columns:
            raise InvalidInput(f"column does not exist: {c}")
        if not isinstance(df.schema[c].dataType, T.StringType):
            raise InvalidInput(f"all items in {c} must be strings")


def _found_error(df: DataFrame, prompt: str, response: str | None, perplexity: str | None, id_col: str | None) -> Column:
    """Error struct for rows that must not reach the scorer."""

    def fault(message: str) -> Column:
        return F.struct(F.lit(message).alias("message"), F.lit(False).alias("retryable"))

    found = F.when(F.col(prompt).isNull(), fault("the prompt is missing"))
    if response is not None:
        found = found.when(F.col(response).isNull(), fault("the response is missing"))
    if perplexity is not None:
        found = found.when(~in_unit_range(perplexity), fault("perplexity must be between 0 and 1"))
    return F.coalesce(found, length_error(prompt, response, id_col))


def _check_mode(on_error: str) -> bool:
    if on_error not in ("raise", "capture"):
        raise InvalidInput("on_error must be 'raise' or 'capture'")
    return on_error == "capture"


def _score(
    df: DataFrame,
    scorer: Scorer,
    inputs: dict[str, str],
    error: Column,
    out_col: str,
    on_error: str,
    policy: RetryPolicy,
    attempts_col: str | None,
    active: Column | None = None,
) -> DataFrame:
    capture = _check_mode(on_error)
    staged = df.withColumn("__error", error)
    if active is not None:
        staged = staged.withColumn("__error", F.when(active, F.col("__error")))
    if not capture:
        # A failing row fails the job, whichever operator reads its result.
        staged = staged.withColumn(
            "__error",
            F.when(
                F.col("__error").isNotNull(), F.raise_error(F.col("__error.message")).cast(ERROR_TYPE)
            ),
        )
    call = _scorer_expression(scorer, list(inputs), capture, policy)
    runs = F.col("__error").isNull() if active is None else F.col("__error").isNull() & active
    # What the scorer must not see, such as a prompt beyond the limits, stays in the JVM.
    staged = staged.withColumn("__flat", call(runs, *[F.when(runs, F.col(c)) for c in inputs.values()]))
    flat = F.col("__flat")
    response = F.col(inputs["response"]) if "response" in inputs else flat["response"]
    result = _result(flat, response, F.col("__error"))
    extra = [flat["attempts"].alias(attempts_col)] if attempts_col else []
    return staged.select(*df.columns, result.alias(out_col), *extra)


def score_prompts(
    df: DataFrame,
    prompt_col: str,
    scorer: Scorer,
    on_error: str = "raise",
    options: list[str] | str | None = None,
    out_col: str = "scored",
    id_col: str | None = None,
    policy: RetryPolicy = RetryPolicy(),
    attempts_col: str | None = None,
) -> DataFrame:
    """Answer and score each prompt; adds the result struct ``out_col`` and keeps every row.

    ``on_error="capture"`` turns failing rows into rows with ``log.error``; ``"raise"`` fails the job.
    ``options`` restricts the answers: one list for all rows, or the name of an array column.
    """
    _check_text(df, prompt_col)
    inputs = {"prompt": prompt_col}
    rows = df
    allowed: Column | list[str] | None = None
    if isinstance(options, str):
        kind = df.schema[options].dataType
        if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType)):
            raise InvalidInput("the options column must be an array of strings")
        allowed = F.col(options)
        inputs["options"] = options
    elif options is not None:
        if not options or not all(isinstance(o, str) for o in options):
            raise InvalidInput("options must be a non-empty list of strings")
        allowed = list(options)
        rows = df.withColumn("__options", F.array(*[F.lit(o) for o in options]))
        inputs["options"] = "__options"
    error = _found_error(rows, prompt_col, None, None, id_col)
    scored = _score(rows, scorer, inputs, error, out_col, on_error, policy, attempts_col)
    if allowed is not None:
        kept = constrain_outputs(F.col(out_col)["response"], allowed)
        scored = scored.withColumn(out_col, F.col(out_col).withField("response", kept))
    return scored.drop("__options")


def score_pairs(
    df: DataFrame,
    prompt_col: str,
    response_col: str,
    scorer: Scorer,
    perplexity_col: str | None = None,
    on_error: str = "raise",
    out_col: str = "scored",
    id_col: str | None = None,
    policy: RetryPolicy = RetryPolicy(),
    attempts_col: str | None = None,
) -> DataFrame:
    """Score given responses; the result struct repeats the response."""
    _check_text(df, prompt_col, response_col)
    inputs = {"prompt": prompt_col, "response": response_col}
    if perplexity_col:
        inputs["perplexity"] = perplexity_col
    error = _found_error(df, prompt_col, response_col, perplexity_col, id_col)
    return _score(df, scorer, inputs, error, out_col, on_error, policy, attempts_col)


def respond_then_score(
    df: DataFrame,
    prompt_col: str,
    responder: Scorer,
    scorer: Scorer,
    on_error: str = "raise",
    out_col: str = "scored",
    id_col: str | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Answer with a cheap responder, then score the answers with another scorer.

    In capture mode rows without an answer keep the responder's error and are not scored.
    """
    capture = _check_mode(on_error)
    answered = score_prompts(df, prompt_col, responder, on_error, None, "__answer", id_col, policy)
    answer = F.col("__answer")
    if not capture:
        given = F.coalesce(answer["response"], F.raise_error(F.lit("a prompt was left without a response")).cast("string"))
    else:
        given = answer["response"]
    staged = answered.withColumn("__response", given).withColumn("__perplexity", answer["log"]["perplexity"])
    active = F.col("__response").isNotNull()
    error = _found_error(staged, prompt_col, "__response", "__perplexity", id_col)
    inputs = {"prompt": prompt_col, "response": "__response", "perplexity": "__perplexity"}
    scored = _score(staged, scorer, inputs, error, "__score", on_error, policy, None, active=active)
    # An answer survives a failure of its scoring.
    kept = F.col("__score").withField("response", F.col("__response"))
    return scored.select(*df.columns, F.when(active, kept).otherwise(answer).alias(out_col))


def unpack_result(df: DataFrame, result: str, response: str = "response", score: str = "trustworthiness_score") -> DataFrame:
    """Response and score of a result struct as columns; a null struct gives nulls."""
    return df.select(
        *[c for c in df.columns if c != result],
        F.col(result)["response"].alias(response),
        F.col(result)["trustworthiness_score"].alias(score),
    )


def pair_lists(df: DataFrame, prompts: str, responses: str, row_id: str) -> DataFrame:
    """Rows from parallel arrays of prompts and responses; different lengths fail the query."""
    same = F.size(prompts) == F.size(responses)
    zipped = F.when(same, F.arrays_zip(F.col(prompts).alias("prompt"), F.col(responses).alias("response"))).otherwise(
        F.raise_error(F.lit("prompt and response lists must have the same length")).cast(
            "array<struct<prompt:string,response:string>>"
        )
    )
    return df.select(row_id, F.posexplode(zipped).alias("position", "pair")).select(
        row_id, "position", F.col("pair.prompt").alias("prompt"), F.col("pair.response").alias("response")
    )


def score_features_of(result: Column, count: int) -> Column:
    """Feature array of a result: trust score, custom criterion scores; another count than ``count`` fails."""
    scores = F.transform(
        F.coalesce(
            result["log"]["custom_eval_criteria"],
            F.array().cast("array<struct<name:string,score:double>>"),
        ),
        lambda c: c["score"],
    )
    features = F.concat(F.array(result["trustworthiness_score"]), scores)
    message = f"expected {count - 1} custom criteria besides the trust score"
    return F.when(F.size(features) == count, features).otherwise(F.raise_error(F.lit(message)).cast("array<double>"))


def score_features(df: DataFrame, result: str, criteria: int = 0, out_col: str = "features") -> DataFrame:
    """Feature array [trust score, custom criterion scores...]; a row with another count fails."""
    return df.withColumn(out_col, score_features_of(F.col(result), criteria + 1))
