"""Settings of the scoring engine, read from JSON and checked."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field, replace

ACTIONS = ("monitor", "annotate", "block")


class SettingsError(ValueError):
    pass


@dataclass(frozen=True)
class Rule:
    threshold: float
    action: str = "monitor"


@dataclass(frozen=True)
class Feedback:
    path: str = "/quality-feedback"
    window_seconds: int = 300
    min_samples: int = 10
    negative_rate: float = 0.3


@dataclass(frozen=True)
class Judge:
    service: str
    mode: str = "always"
    path: str = "/v1/chat/completions"
    model: str = "gpt-5.4-mini"
    api_key: str | None = None
    instructions: str | None = None
    context_chars: int = 8000
    json_mode: bool = True
    suspicion: float = 0.3
    timeout_ms: int = 5000


@dataclass(frozen=True)
class Settings:
    hallucination: Rule = Rule(0.6)
    toxicity: Rule = Rule(0.5)
    bias: Rule = Rule(0.5)
    anomaly: Rule = Rule(0.7)
    toxicity_terms: tuple[str, ...] = ()
    bias_groups: tuple[str, ...] = ()
    low_logprob: float = -1.0
    length_z: float = 3.0
    max_bytes: int = 262_144
    warmup: int = 30
    feedback: Feedback | None = field(default_factory=Feedback)
    judge: Judge | None = None
    judge_misconfigured: bool = False
    strip_accept_encoding: bool = True
    report_all: bool = False
    withheld_text: bool = False
    guard_token: str | None = None

    def rule(self, category: str) -> Rule:
        return getattr(self, category)

    @property
    def may_rewrite(self) -> bool:
        return self.report_all or any(self.rule(c).action != "monitor" for c in ("hallucination", "toxicity", "bias", "anomaly"))

    @staticmethod
    def from_json(text: str | bytes) -> Settings:
        if not text:
            raise SettingsError("no configuration")
        try:
            return replace(from_dict(json.loads(text)), guard_token=guard_token(text))
        except (TypeError, json.JSONDecodeError) as e:
            raise SettingsError(str(e)) from e


def guard_token(config: str | bytes) -> str:
    """What marks the engine's own calls to the judge: the same wherever the configuration is, and not to be guessed without it."""
    return hashlib.sha256(b"judge call\xff" + (config.encode() if isinstance(config, str) else config)).hexdigest()[:16]


def normalise(terms: list[str]) -> tuple[str, ...]:
    """Terms as the rules compare them; a curly apostrophe is not folded here, and splits a term."""
    found = []
    for t in terms:
        # \w has letters, marks and numbers; _ separates words
        words = [w.strip("'") for w in re.split(r"(?:[^\w']|_)+", t.lower())]
        if any(words):
            found.append(" ".join(w for w in words if w))
    return tuple(found)


def from_dict(given: dict) -> Settings:
    if not isinstance(given, dict):
        raise SettingsError("the configuration is not an object")
    snake = lambda k: re.sub(r"(?<!^)([A-Z])", r"_\1", k).lower()
    g = {snake(k): v for k, v in given.items() if v is not None}

    def number(key: str, default, low=None, high=None):
        x = g.get(key, default)
        if isinstance(x, bool) or not isinstance(x, (int, float)):
            raise SettingsError(f"{key} is not a number")
        if (low is not None and x < low) or (high is not None and x > high):
            raise SettingsError(f"{key} is out of range: {x}")
        return x

    def one_of(key: str, default: str, options: tuple[str, ...]) -> str:
        x = g.get(key, default)
        if x not in options:
            raise SettingsError(f"{key} must be one of {', '.join(options)}")
        return x

    rules = {c: Rule(float(number(f"{c}_threshold", t, 0, 1)), one_of(f"{c}_action", "monitor", ACTIONS)) for c, t in (("hallucination", 0.6), ("toxicity", 0.5), ("bias", 0.5), ("anomaly", 0.7))}
    path = str(g.get("feedback_path", "/quality-feedback")).strip()
    feedback = Feedback(path, int(number("feedback_window_seconds", 300, 10)), int(number("feedback_min_samples", 10, 1)), float(number("feedback_negative_rate_threshold", 0.3, 0, 1))) if path else None
    mode = one_of("judge_mode", "always", ("off", "onSuspicion", "always"))
    service = g.get("judge_service")
    judge = None
    if mode != "off" and service:
        text = lambda k, d: str(g.get(k, d)).strip() or d
        judge = Judge(
            service, mode, text("judge_path", Judge.path), text("judge_model", Judge.model), g.get("judge_api_key") or None, str(g.get("judge_instructions", "")).strip() or None,
            min(100_000, int(number("judge_context_chars", 8000, 0))), bool(g.get("judge_json_mode", True)), float(number("judge_suspicion_score", 0.3, 0, 1)), min(30_000, int(number("judge_timeout_ms", 5000, 100))),
        )
    return Settings(
        **rules, toxicity_terms=normalise(g.get("toxicity_terms", [])), bias_groups=normalise(g.get("bias_group_terms", [])),
        low_logprob=float(number("low_confidence_logprob", -1.0, None, 0)), length_z=float(number("length_z_score_threshold", 3.0, 1)),
        max_bytes=min(10 << 20, int(number("max_inspected_bytes", 262_144, 1024))), warmup=int(number("baseline_warmup_samples", 30, 1)),
        feedback=feedback, judge=judge, judge_misconfigured="judge_mode" in g and mode != "off" and not service,
        strip_accept_encoding=bool(g.get("strip_accept_encoding", True)), report_all=bool(g.get("report_all", False)), withheld_text=bool(g.get("include_withheld_text", False)),
    )
