"""Models fitted once and frozen: the JSON files beside this module, written by tools/freeze_models.py.

They give scores and importances that do not depend on a fit, so that SQL can
check what is built on a model.
"""

from __future__ import annotations

from functools import cache
from importlib.resources import files

from riskframe.models.compiled import Linear, Trees, from_json


@cache
def _read(name: str):
    return from_json((files(__package__) / f"{name}.json").read_text())


def logreg() -> Linear:
    return _read("logreg")


def forest() -> Trees:
    return _read("forest")


def boosted() -> Trees:
    return _read("boosted")
