"""Models and services behind injected interfaces, with deterministic stand-ins.

Every operator takes an object with one method, sends it whole Arrow batches on
the executors, retries, and reports ``status`` and ``error`` instead of failing
the job.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Scorer(Protocol):
    """Distributions over (backchannel, floor_taking, silence) for prompts."""

    def score(self, prompts: list[str]) -> list[tuple[float, float, float]]: ...


#: A conversation with a service: (role, content) of each message.
Chat = list[tuple[str, str]]


class Generator(Protocol):
    """One text for each conversation."""

    def generate(self, chats: list[Chat], temperature: float) -> list[str]: ...


class Synthesizer(Protocol):
    """Samples at 24 kHz, as a length, for each text and voice."""

    def render(self, texts: list[str], voices: list[str]) -> list[int]: ...


def _unit(*parts: object) -> float:
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2**32


@dataclass
class HashScorer:
    """A stand-in whose distribution depends on the prompt only."""

    seed: int = 42

    def score(self, prompts: list[str]) -> list[tuple[float, float, float]]:
        out = []
        for p in prompts:
            a, b, c = (_unit(self.seed, k, p) + 0.01 for k in "bfs")
            out.append((a / (a + b + c), b / (a + b + c), c / (a + b + c)))
        return out


@dataclass
class EchoGenerator:
    """A stand-in that returns the last line of its first message, at low temperature at times with a role before it."""

    def generate(self, chats: list[Chat], temperature: float) -> list[str]:
        return [("user: " if temperature < 0.75 and _unit(chat[0][1]) < 0.3 else "") + chat[0][1].rsplit("\n", 1)[-1] for chat in chats]


@dataclass
class HalfJudge:
    """A stand-in judge: a rewrite is done once it has half as many turns as its source."""

    def generate(self, chats: list[Chat], temperature: float) -> list[str]:
        out = []
        for chat in chats:
            source, spoken = chat[0][1].split("\n=====\n")
            out.append(json.dumps({"done": 2 * len(spoken.split("\x1e")) >= len(source.split("\x1e")), "stop": True}))
        return out


@dataclass
class SilentSynthesizer:
    """A stand-in that renders 1,440 samples a character, and fails on empty texts."""

    def render(self, texts: list[str], voices: list[str]) -> list[int]:
        if any(not t for t in texts):
            raise ValueError("empty text")
        return [1440 * len(t) for t in texts]


# Prefixes of model names by the backend that serves them, and the options that turn thinking off there.
ROUTES = (("anthropic", ("claude", "anthropic"), True), ("openai", ("gpt-", "chatgpt-", "o1", "o3", "o4"), False), ("gemini", ("gemini",), True))
THINKING_OFF = {"hosted": {"chat_template_kwargs": {"enable_thinking": False}}, "gemini": {"google_thinking_budget": 0}}


def backend_of(model: str) -> str:
    """The backend that serves a model: anthropic, openai, gemini, or hosted for all other names."""
    low = model.lower()
    for name, marks, anywhere in ROUTES:
        if any(m in low for m in marks) if anywhere else model.startswith(marks):
            return name
    return "hosted"


def model_for(settings: Mapping[str, str | None] | None, role: str, default: str) -> str:
    """The model of one role: its own, else the shared one, else ``default``."""
    settings = settings or {}
    return settings.get(role) or settings.get("model") or default


def request_options(model: str, thinking: bool) -> dict | None:
    """What a request must add to turn thinking off; null where a backend has no such option, or thinking stays on."""
    return None if thinking else THINKING_OFF.get(backend_of(model))


def client_for(model: str, factories: Mapping[str, Callable[[str], object]]) -> object:
    """The service for a model, made on the executor by its backend's factory; an error if there is none."""
    backend = backend_of(model)
    if backend not in factories:
        raise ValueError(f"no factory for {backend} models ({model!r}); there are {sorted(factories)}")
    return factories[backend](model)


def named_delay(error: str, default: float = 30.0) -> float:
    """The seconds that an error asks to wait, ``default`` if it names none."""
    found = re.search(r"retry in\s+([0-9]+(?:\.[0-9]+)?)\s*s", error)
    return float(found.group(1)) if found else default


@dataclass
class Backoff:
    """Waits between attempts: doubling from ``first``, at least what a rate-limit error asks for, at most ``most`` seconds."""

    attempts: int = 2
    first: float = 0.0
    most: float = 60.0
    sleep: Callable[[float], None] = time.sleep

    def wait(self, attempt: int, error: str) -> float:
        delay = self.first * 2**attempt
        if "429" in error or "RESOURCE_EXHAUSTED" in error:
            delay = max(delay, named_delay(error))
        delay = min(delay, self.most)
        if delay > 0:
            self.sleep(delay)
        return delay


@dataclass
class Pace:
    """At least ``seconds`` between the calls of one task; with n tasks at a time a service sees n / seconds calls a second."""

    seconds: float = 0.0
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    last: float | None = None

    def hold(self) -> None:
        if self.seconds <= 0:
            return
        if self.last is not None and (left := self.seconds - (self.clock() - self.last)) > 0:
            self.sleep(left)
        self.last = self.clock()


def in_batches(rows: DataFrame, column: str, call: Callable[[pd.DataFrame], list], out: str, kind: str, fallback: object = None, attempts: int = 2, pause: float = 0.0, backoff: Backoff | None = None, pace: Pace | None = None, size: int | None = None) -> DataFrame:
    """``rows`` with ``out`` (of type ``kind``), ``status`` (ok, retried or fallback) and ``error``.

    ``call`` gets rows and returns a value for each: the rows of an Arrow batch, or
    ``size`` of them at a time.  Rows whose ``column`` is null never reach it and
    get ``fallback``.  A call that fails is made again for each half of its rows,
    so one bad row costs few calls; a row that fails alone is retried by
    ``backoff`` and gets ``fallback`` in the end, with its error.
    """
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, {out} {kind}, status string, error string"
    waits = backoff or Backoff(attempts=attempts, first=pause)

    def told(f: pd.DataFrame, held: Pace) -> list[tuple[object, str, str | None]]:
        try:
            held.hold()
            return [(v, "ok", None) for v in call(f)]
        except Exception as e:  # noqa: BLE001 - whatever a service raises is a status
            why = f"{type(e).__name__}: {e}"
        if len(f) > 1:
            half = len(f) // 2
            return told(f.iloc[:half], held) + told(f.iloc[half:], held)
        for attempt in range(waits.attempts - 1):
            waits.wait(attempt, why)
            try:
                held.hold()
                return [(call(f)[0], "retried", None)]
            except Exception as e:  # noqa: BLE001
                why = f"{type(e).__name__}: {e}"
        return [(fallback, "fallback", why)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pace or Pace()
        for f in frames:
            got: list[tuple[object, str, str | None]] = [(fallback, "fallback", "no input")] * len(f)
            there = f[column].notna().to_numpy().nonzero()[0]
            for k in range(0, len(there), size or max(1, len(there))):
                at = there[k : k + (size or len(there))]
                for i, x in zip(at, told(f.iloc[at], held)):
                    got[i] = x
            yield f.assign(**{out: [g[0] for g in got], "status": [g[1] for g in got], "error": [g[2] for g in got]})

    return rows.mapInPandas(run, schema)


def scored(slots: DataFrame, prompt: str, scorer: Scorer) -> DataFrame:
    """Slots with ``probs`` (backchannel, floor_taking, silence); silence where the scorer fails."""
    return in_batches(slots, prompt, lambda f: [list(p) for p in scorer.score(f[prompt].tolist())], "probs", "array<double>", [0.0, 0.0, 1.0])


def rendered(units: DataFrame, text: str, voice: str, synthesizer: Synthesizer) -> DataFrame:
    """Units with ``samples``; 0, silence, where rendering fails."""
    return in_batches(units, text, lambda f: synthesizer.render(f[text].tolist(), f[voice].tolist()), "samples", "bigint", 0)


def rendered_batches(calls: DataFrame, texts: str, voice: str, synthesizer: Synthesizer) -> DataFrame:
    """Batches (an array of texts and a voice) with ``samples``, an array; silence for each text of a batch that fails, after each was tried alone."""

    def call(f: pd.DataFrame) -> list[list[int]]:
        out = []
        for own, v in zip(f[texts], f[voice]):
            own = list(own)
            try:
                out.append(synthesizer.render(own, [v] * len(own)))
            except Exception:  # noqa: BLE001 - a text that fails is silent
                alone = []
                for t in own:
                    try:
                        alone += synthesizer.render([t], [v])
                    except Exception:  # noqa: BLE001
                        alone.append(0)
                out.append(alone)
        return out

    return in_batches(calls, texts, call, "samples", "array<bigint>", [])


def valid_backchannel(text: str) -> bool:
    """One to three words, no label, no dots, exclamation or dash."""
    low = text.lower()
    return 1 <= len(text.split()) <= 3 and not low.startswith(("backchannel", "listener", "speaker", "the ", "this ")) and not any(x in text for x in ("...", "!", "—"))


def backchannels(rows: DataFrame, prompt: str, generator: Generator, fallback: str, attempts: int = 3) -> DataFrame:
    """``rows`` with ``backchannel``, in lower case without quotes, and ``status``; one that isn't valid is asked for again and in the end is the row's ``fallback``."""

    def call(f: pd.DataFrame) -> list[str]:
        out = []
        for answer in generator.generate([[("user", p)] for p in f[prompt]], 0.7):
            told = " ".join(answer.rsplit("</think>", 1)[-1].strip().strip('"').strip().lower().split())
            if not valid_backchannel(told):
                raise ValueError(f"no backchannel: {told[:40]!r}")
            out.append(told)
        return out

    got = in_batches(rows, prompt, call, "_told", "string", None, attempts=attempts)
    return got.withColumn("backchannel", F.coalesce("_told", fallback)).drop("_told", "error")


def gated(rows: DataFrame, prompt: str, judge: Generator | None) -> DataFrame:
    """The rows for which a judge says YES; all of them without a judge.  A null or empty prompt, and a judge that fails, drop the row."""
    if judge is None:
        return rows
    given = rows.withColumn("_asked", F.nullif(F.col(prompt), F.lit("")))
    told = in_batches(given, "_asked", lambda f: judge.generate([[("user", p)] for p in f["_asked"]], 0.0), "_answer", "string", None)
    return told.where(F.upper("_answer").contains("YES")).drop("_asked", "_answer", "status", "error")


def read_turns(answer: str | None) -> list[dict]:
    """The list of turns that a structured answer holds, as JSON or inside of it; the empty list if there is none."""
    for text in (answer or "", *re.findall(r"\[.*\]", answer or "", re.S)[:1]):
        try:
            found = json.loads(text)
        except ValueError:
            continue
        if isinstance(found, dict):
            found = next((v for v in found.values() if isinstance(v, list)), None)
        if isinstance(found, list):
            return [t for t in found if isinstance(t, dict)]
    return []


def is_done(answer: str) -> bool:
    """Whether a judge's JSON says ``done``: true and nothing else counts."""
    for text in (answer, *re.findall(r"\{.*\}", answer, re.S)[:1]):
        try:
            found = json.loads(text)
            return isinstance(found, dict) and found.get("done") is True
        except ValueError:
            continue
    return False


#: What a generator is told when its answer began with a label.
REMINDER = "The last answer began with an index, a role or a quote. Say the same again as plain speech, from its first word."


def clean_turn(generator: Generator, prompt: str, is_clean: Callable[[str], bool], clean: Callable[[str], str], temperature: float = 0.7, attempts: int = 4) -> tuple[str, int]:
    """(text, tries): an answer that is clean, or the last one cleaned.

    Every further try is told its predecessor and the reminder, a tenth warmer, up
    to 1.
    """
    chat: Chat = [("user", prompt)]
    new, tries = "", 0
    for tries in range(1, attempts + 1):
        new = generator.generate([chat], min(1.0, temperature + 0.1 * (tries - 1)))[0]
        if new and is_clean(new):
            break
        chat = [("user", prompt), ("assistant", new), ("user", REMINDER)]
    return clean(new), tries


def rewritten(
    dialogues: DataFrame, key: str, turns: str, generator: Generator, is_clean: Callable[[str], bool], clean: Callable[[str], str], max_turns: int | None = None, attempts: int = 4,
    judge: Generator | None = None, stop_every: int = 0, stop_from: int = 0,
) -> DataFrame:
    """(key, turn, role, content, tries): each dialogue's turns written anew one after the other.

    A turn's prompt holds the turns rewritten before it, so a dialogue is serial
    and dialogues run side by side, one row each, without a shuffle.  All turns
    are written unless ``max_turns`` is given and above 0; then that many.  After
    every ``stop_every`` turns, from ``stop_from`` on, the judge is asked whether
    the rewrite is done; a judge that fails doesn't end it.
    """
    kind = dialogues.schema[key].dataType.simpleString()

    def done(source: list[str], said: list[str]) -> bool:
        if judge is None or stop_every <= 0 or len(said) < stop_from or len(said) % stop_every:
            return False
        try:
            return is_done(judge.generate([[("user", "\x1e".join(source) + "\n=====\n" + "\x1e".join(said))]], 0.0)[0])
        except Exception:  # noqa: BLE001 - no answer is no end
            return False

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for k, own in zip(f[key], f[turns]):
                own = [] if own is None else list(own)
                source, said = [t["content"] or "" for t in own], []
                for i, t in enumerate(own):
                    if (max_turns and 0 < max_turns <= i) or (i and done(source, said)):
                        break
                    new, tries = clean_turn(generator, "\n".join([*said[-4:], source[i]]), is_clean, clean, attempts=attempts)
                    said.append(new)
                    out.append((k, i, t["role"], new, tries))
            yield pd.DataFrame(out, columns=[key, "turn", "role", "content", "tries"])

    return dialogues.select(key, turns).mapInPandas(run, f"{key} {kind}, turn int, role string, content string, tries int")
