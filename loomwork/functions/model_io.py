"""What goes to a model and what comes back, as plain values for providers and as Columns for logs of answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names by which reasoning models are told.
REASONING = ("gpt-5", "o1", "o3", "o4-mini")


def is_reasoning(model: str, deployment: str | None = None, style: str = "auto") -> bool:
    """Whether a model takes the reasoning shape of a request; style other than auto decides alone."""
    return style == "reasoning" if style != "auto" else any(h in f"{model} {deployment or ''}".lower() for h in REASONING)


def chat_request(system: str, user: str, schema: dict, max_output: int, reasoning: bool = False, effort: str = "low", seed: int = 7) -> dict:
    """A chat request with a JSON schema for its answer; reasoning models take an effort, others temperature 0 and a seed."""
    limits = {"max_completion_tokens": max_output, "reasoning_effort": effort} if reasoning else {"max_tokens": max_output, "temperature": 0, "seed": seed}
    turns = [{"role": "system", "content": system}, {"role": "user", "content": user}]
    return {"messages": turns, "response_format": {"type": "json_schema", "json_schema": schema}} | limits


def usage(body: Column) -> Column:
    """prompt, completion and cached tokens of an answer's JSON; cached is never over prompt."""
    number = lambda path: F.coalesce(F.get_json_object(body, path).try_cast("bigint"), F.lit(0).cast("bigint"))
    prompt = number("$.usage.prompt_tokens")
    return F.struct(prompt.alias("prompt"), number("$.usage.completion_tokens").alias("completion"), F.least(prompt, number("$.usage.prompt_tokens_details.cached_tokens")).alias("cached"))


def vectors_in_order(body: Column, dims: int) -> Column:
    """Vectors of an embedding answer by their index; a wrong dimension stops the job."""
    data = F.from_json(F.get_json_object(body, "$.data"), "array<struct<index:int,embedding:array<float>>>")
    ordered = F.transform(F.array_sort(data), lambda d: d["embedding"])
    return F.when(F.assert_true(F.forall(ordered, lambda v: F.size(v) == dims), "wrong dimensions").isNull(), ordered)


def transcript_text(body: Column) -> Column:
    """`text` of a JSON answer, else the body itself, trimmed."""
    return F.trim(F.coalesce(F.get_json_object(body, "$.text"), body))


def vision_tokens(parts: Column, image_tokens: Column, max_output: int) -> Column:
    """Tokens of a request of parts (struct<type, text>): a quarter of its text's characters, the image and the output limit."""
    text = F.aggregate(F.filter(parts, lambda p: p["type"] == "text"), F.lit(0), lambda acc, p: acc + F.length(F.coalesce(p["text"], F.lit(""))))
    return F.floor(text / 4).cast("bigint") + image_tokens + F.lit(max_output)
