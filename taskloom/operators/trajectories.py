"""Agent trajectories into messages, styles and training rows, as expressions over nested columns."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import prepare
from .windows import cap_per_key, shuffled

MESSAGES = "array<struct<role:string,content:string>>"
#: Answers that end a run early, and parameters whose values stand on lines of their own.
STOPPED = ("Exit due to cost limit", "Exit due to context window")
BLOCK_PARAMETERS = ("file_text", "old_str", "new_str")
SUBMIT = (
    "Since we have successfully fixed the issue and verified it works, let's submit the changes:\n\n<function=submit>\n</function>"
)


def history(trajectory: dict) -> list[dict]:
    """The message history of a run: the last step's ``messages`` without its last, else its ``query``;
    the step before it if the last one only says why the run stopped. Empty without steps."""
    steps = trajectory.get("trajectory") or []
    if not steps:
        return []
    if "messages" in steps[-1]:
        return steps[-1]["messages"][:-1]
    at = -2 if steps[-1].get("response") in STOPPED and len(steps) > 1 else -1
    return steps[at].get("query") or []


def _text(content: object) -> str:
    if isinstance(content, list):
        return str(content[0].get("text", "")) if content else ""
    return content if isinstance(content, str) else ""


def tool_action(calls: list[dict] | None) -> str:
    """Tool calls as tags; arguments keep the order in which they are written."""
    out = []
    for call in calls or []:
        arguments = json.loads(call["function"]["arguments"])
        gap = lambda k: "\n" if k in BLOCK_PARAMETERS else ""
        parts = [f"<parameter={k}>{gap(k)}{v}{gap(k)}</parameter>" for k, v in arguments.items()]
        out.append("\n".join([f"<function={call['function']['name']}>", *parts, "</function>"]))
    return "\n".join(out)


def ticks(message: dict, system: str | None) -> str:
    if message["role"] == "assistant":
        return f"{message.get('thought', '')}\n\n```\n{message.get('action', '')}\n```"
    return _text(message.get("content"))


def tags(message: dict, system: str | None) -> str:
    if message["role"] == "system" and system is not None:
        return system
    if message["role"] != "assistant":
        return _text(message.get("content"))
    if message.get("content") == STOPPED[0]:
        return SUBMIT
    content = message.get("thought", _text(message.get("content")))
    if "tool_calls" in message:
        content += f"\n\n{tool_action(message['tool_calls'])}"
    return content.strip()


def plain(message: dict, system: str | None) -> str:
    return _text(message.get("content"))


#: Styles by name; a style gives a message's content.
STYLES = {"ticks": ticks, "xml": tags, "tool": plain}


def messages_of(trajectories: DataFrame, keys: list[str], text: str, style: str, system: str | None = None) -> DataFrame:
    """(keys, messages, error): each trajectory (JSON text) in a style; tools speak as users, except in ``tool``.

    A trajectory that can't be read has no messages and an error; a null one has neither.
    """
    prepare(trajectories.sparkSession)
    kinds, form = dict(trajectories.dtypes), STYLES[style]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, errors = [], []
            for value in batch["__text"]:
                try:
                    found.append([
                        {"role": "user" if m["role"] == "tool" and style != "tool" else m["role"], "content": form(m, system)}
                        for m in history(json.loads(value))
                    ] if value is not None else None)
                    errors.append(None)
                except (ValueError, KeyError, TypeError, AttributeError) as e:
                    found.append(None)
                    errors.append(type(e).__name__)
            out = batch.drop(columns="__text")
            yield out.assign(messages=pd.Series(found, dtype=object, index=out.index), error=pd.Series(errors, dtype=object, index=out.index))

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"messages {MESSAGES}", "error string"])
    return trajectories.select(*keys, F.col(text).alias("__text")).mapInPandas(run, schema)


def transcript_messages(text: Column) -> Column:
    """Messages of a plain transcript: lines SYSTEM, THOUGHT, ACTION, OBSERVATION with a colon start parts.
    A thought and its action are one assistant message each; observations are the user's."""
    kinds = "SYSTEM|THOUGHT|ACTION|OBSERVATION"
    part = rf"(?ms)^({kinds}):[ \t]*\n?(.*?)\s*(?=^(?:{kinds}):|\z)"
    names, texts = F.regexp_extract_all(text, F.lit(part), F.lit(1)), F.regexp_extract_all(text, F.lit(part), F.lit(2))
    role = lambda n: F.when(n == "SYSTEM", "system").when(n == "OBSERVATION", "user").otherwise("assistant")
    return F.zip_with(names, texts, lambda n, t: F.struct(role(n).alias("role"), t.alias("content")))


def chat_text(messages: Column) -> Column:
    """Messages as text for training, each between markers of its role."""
    one = lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n"))
    return F.array_join(F.transform(messages, one), "")


def training_rows(messages: DataFrame, reports: DataFrame, patches: DataFrame, key: str = "instance_id") -> DataFrame:
    """Messages with their grade and patch: rows without a report drop out, without a patch keep ''.

    reports: key, resolved; patches: key, model_patch; both unique in the key.
    """
    return (
        messages.join(reports.select(key, F.coalesce("resolved", F.lit(False)).alias("resolved")), key)
        .join(patches.select(key, F.col("model_patch").alias("patch")), key, "left")
        .withColumn("patch", F.coalesce("patch", F.lit("")))
    )


def rating_messages(statement: Column, patch: Column, label: Column, system: str) -> Column:
    """One rater example: the system's text, the statement with its patch, and the label as the answer."""
    one = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    body = F.concat(F.lit("<issue>\n"), statement, F.lit("\n</issue>\n<patch>\n"), patch, F.lit("\n</patch>"))
    return F.array(one("system", F.lit(system)), one("user", body), one("assistant", label))


def training_set(tables: list[DataFrame], most: int = 3, seed: int = 24, key: str = "instance_id", id_col: str = "traj_id") -> DataFrame:
    """Several collections as one: at most ``most`` rows of each instance, in hash order, sorted by that order."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t, allowMissingColumns=True)
    return shuffled(cap_per_key(rows, key, most, seed, [id_col]), seed, [id_col])
