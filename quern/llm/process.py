"""Objects that live as long as a worker process."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable


def per_process(key: Hashable, make: Callable):
    """The object made by the first call with this key in this process.

    Functions may be sent to the workers by value; their module globals are then made anew for each task. The
    list of loaded modules is not.
    """
    store = sys.modules.setdefault("_quern_per_process", types.ModuleType("_quern_per_process"))
    made = store.__dict__.setdefault("made", {})
    if key not in made:
        made[key] = make()
    return made[key]
