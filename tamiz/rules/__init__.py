"""Declarative quality rules: row rules, set rules, scoring, summaries."""

from tamiz.rules.evaluate import evaluate, failed_samples, failed_set_samples
from tamiz.rules.model import Rule, rule

__all__ = ["Rule", "evaluate", "failed_samples", "failed_set_samples", "rule"]
