"""Entity history: events to entity-periods with trailing and opponent features."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyline.contracts import require_columns
from tallyline.operators.rollup import (
    add_event_flags,
    add_opponent_form,
    event_cells,
    group_periods,
    periods_of_sides,
    sides_of_cells,
)
from tallyline.operators.trailing import (
    MAX_ROWS_PER_TASK,
    add_entity_form,
    add_group_form,
    add_rates,
)
from tallyline.schemas import HISTORY_CONTRACT, MODEL_FEATURES
from tallyline.session import materialize
from tallyline.sources.checked import write_checked


def entity_history(
    events: DataFrame, *, max_rows_per_task: int | None = MAX_ROWS_PER_TASK, strict: bool = True
) -> DataFrame:
    """The complete history table.

    The events are read once, with pruned columns, at every size: hashed into cells, which
    are written. Both rollups come from the cells and are written too; checks, the search
    for hot keys and the windows read those copies.
    """
    cells = event_cells(add_event_flags(events)).filter("game_date is not null and game_pk is not null")
    cells = materialize(cells, "cells")
    periods = periods_of_sides(materialize(sides_of_cells(cells), "sides"), cells)
    if strict:
        # Counted by the job that writes them. Two spellings of one entity in a period are
        # two rows of one key.
        periods = write_checked(periods, HISTORY_CONTRACT).good
    else:
        periods = materialize(periods, "periods")
    # The windows come before the join: looking for hot keys then reads rollups only.
    form = add_group_form(materialize(group_periods(cells, strikeouts="strikeouts"), "groups"), max_rows_per_task=max_rows_per_task)
    history = add_entity_form(periods, max_rows_per_task=max_rows_per_task)
    history = add_rates(add_opponent_form(history, form))
    require_columns(history, MODEL_FEATURES, "entity_periods")
    return history
