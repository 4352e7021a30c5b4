"""The eleven event plans (E1-E11), by pipeline name."""

from .base import DocKind, EventPlan, PlanContext
from .battle import Battle
from .deposits import Deposits
from .game_profile import GameProfile
from .prod_move import ProdMove
from .profile import Profile
from .progress import Progress
from .regs import Regs
from .resources import Resources
from .sessions import Sessions
from .set_level import SetLevel
from .trigger import Trigger

PLANS = {p.name: p for p in (Sessions(), Deposits(), Trigger(), GameProfile(), Profile(), Regs(),
                             SetLevel(), Resources(), ProdMove(), Battle(), Progress())}


def plan(name: str) -> EventPlan:
    return PLANS[name]


__all__ = ["DocKind", "EventPlan", "PlanContext", "PLANS", "plan"]
