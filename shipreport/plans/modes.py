"""Shipment modes: what differs between the branches of a report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Mode:
    """One branch.

    ``booked``: flight and times come from carrier bookings and the number from the
    master bill; otherwise they are the house bill's own or come from milestones.
    ``listed_headers``: the invoice header's customer must be in the list as well.
    """

    code: str
    product_line: str
    booked: bool
    listed_headers: bool


def same_case(modes: Sequence[Mode], ignore_case: bool) -> list[Mode]:
    """Modes with their codes as the folded ``mode`` columns have them."""
    return [replace(m, code=m.code.rstrip().upper()) if ignore_case else m for m in modes]


# Mode codes and product lines.
AIR_MODES = (
    Mode("AE", "AMS", booked=True, listed_headers=True),
    Mode("AI", "AMS", booked=True, listed_headers=True),
    Mode("3A", "3PS", booked=False, listed_headers=False),
)
