"""Steps over named frames, with injected inputs and an enforced schema: as a plain list, or as a graph."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULTS, Settings
from ..operators.frames import require_columns
from ..session import computed_once

Step = Callable[[dict[str, DataFrame], Settings], dict[str, DataFrame]]


def with_schema(result: DataFrame, schema: Mapping[str, str] | None) -> DataFrame:
    """Columns of ``schema`` cast to their types; other columns stay."""
    if not schema:
        return result
    require_columns(result, list(schema))
    return result.withColumns({c: F.col(c).cast(kind) for c, kind in schema.items()})


def run_steps(
    frames: Mapping[str, DataFrame],
    steps: Sequence[Step],
    settings: Settings = DEFAULTS,
    output: str = "out",
    schema: Mapping[str, str] | None = None,
) -> DataFrame:
    """Each step maps frames to frames; ``output`` is cast to ``schema``, other columns stay."""
    state = dict(frames)
    for step in steps:
        state = step(state, settings)
    return with_schema(state[output], schema)


@dataclass(frozen=True)
class Node:
    """A step of a graph: ``build`` takes the frames in ``needs``, in that order, and the settings."""

    name: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]


def run_graph(
    frames: Mapping[str, DataFrame],
    nodes: Sequence[Node],
    settings: Settings = DEFAULTS,
    output: str = "out",
    schema: Mapping[str, str] | None = None,
) -> DataFrame:
    """The frame ``output`` of a graph of steps.

    Injected ``frames`` take the place of a step of the same name. Only steps that the output needs are built, each
    once; a frame that two steps read is stored unless it is a plain scan.
    """
    known = {n.name: n for n in nodes}
    if len(known) < len(nodes):
        raise ValueError("two steps have one name")
    order: list[Node] = []
    open_names: list[str] = []

    def visit(name: str) -> None:
        if name in frames or any(n.name == name for n in order):
            return
        if name in open_names:
            raise ValueError(f"steps need each other: {' > '.join([*open_names, name])}")
        if name not in known:
            raise KeyError(f"no step and no frame gives {name}")
        open_names.append(name)
        for need in known[name].needs:
            visit(need)
        open_names.pop()
        order.append(known[name])

    visit(output)
    readers = Counter(need for node in order for need in dict.fromkeys(node.needs))
    state = dict(frames)
    for node in order:
        built = node.build(*[state[need] for need in node.needs], settings)
        state[node.name] = computed_once(built, node.name) if readers[node.name] > 1 else built
    return with_schema(state[output], schema)
