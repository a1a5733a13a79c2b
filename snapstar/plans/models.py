"""The models and what each of them reads: their order, and parts of them."""

from __future__ import annotations

from collections.abc import Mapping

from snapstar.plans.marts import BRIDGES, DIMENSIONS, FACT, FACT_VIEW
from snapstar.schemas import STAGING

#: What each model reads. A staging view reads a published table, which is no model.
MODELS: dict[str, tuple[str, ...]] = {
    **{view: () for view in STAGING},
    **{name: (view,) for name, (view, _) in (DIMENSIONS | BRIDGES).items()},
    FACT: (FACT_VIEW,),
}


class Cycle(ValueError):
    """Models that read one another."""


def levels(models: Mapping[str, tuple[str, ...]]) -> list[list[str]]:
    """The models in an order that each can be built in: those of a level read earlier levels only."""
    left, found = dict(models), []
    if unknown := {r for refs in models.values() for r in refs} - {*models}:
        raise ValueError(f"no such model: {', '.join(sorted(unknown))}")
    while left:
        ready = sorted(name for name, refs in left.items() if not left.keys() & {*refs})
        if not ready:
            raise Cycle(", ".join(sorted(left)))
        found.append(ready)
        for name in ready:
            del left[name]
    return found


def below(models: Mapping[str, tuple[str, ...]], name: str) -> set[str]:
    """The model and all that it reads, directly or not."""
    found, left = set(), [name]
    while left:
        if (one := left.pop()) not in found:
            found.add(one)
            left += models[one]
    return found


def select(choice: str | None, models: Mapping[str, tuple[str, ...]] = MODELS) -> set[str]:
    """The models of a choice, all when there is none: names, each with a + before it for all that it reads, and a +
    after it for all that read it, separated by spaces or commas."""
    if not choice:
        return {*models}
    found = set()
    for part in choice.replace(",", " ").split():
        name = part.strip("+")
        if name not in models:
            raise ValueError(f"no such model: {name}")
        found.add(name)
        if part.startswith("+"):
            found |= below(models, name)
        if part.endswith("+"):
            found |= {other for other in models if name in below(models, other)}
    return found


def part(names: set[str], models: Mapping[str, tuple[str, ...]] = MODELS) -> dict[str, tuple[str, ...]]:
    """These models only, with what they read among them."""
    return {name: tuple(r for r in refs if r in names) for name, refs in models.items() if name in names}
