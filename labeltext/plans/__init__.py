"""Whole jobs put together from the operators."""

from labeltext.plans.accounting import write_accounted
from labeltext.plans.corpus import funnel, prepare_corpus
from labeltext.plans.experiments import evaluate_experiment, run_experiment

__all__ = ["evaluate_experiment", "funnel", "prepare_corpus", "run_experiment", "write_accounted"]
