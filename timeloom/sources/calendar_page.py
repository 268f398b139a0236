"""Meeting dates from a central bank's calendar page."""

from __future__ import annotations

import calendar
import datetime as dt
import re
from html.parser import HTMLParser

MONTHS = {name.lower(): i for i, name in enumerate(calendar.month_name) if name} | {name.lower(): i for i, name in enumerate(calendar.month_abbr) if name}
_YEAR = re.compile(r"\b(20\d\d)\b.*\bmeetings\b", re.I)
_MONTH = re.compile(r"^([A-Za-z]{3,9})\.?(?:\s*/\s*([A-Za-z]{3,9})\.?)?$")
_DAYS = re.compile(r"^(\d{1,2})(?:\s*[-–]\s*(\d{1,2}))?\s*(\*?)")


class _Lines(HTMLParser):
    def __init__(self):
        super().__init__()
        self.lines: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.lines.append(" ".join(data.split()))


def meetings(html: str) -> list[tuple[dt.date, bool]]:
    """(last day, has projections) of each meeting: a year's heading, then lines of months and lines of days, starred ones with projections."""
    page = _Lines()
    page.feed(html)
    out, year, months = set(), None, None
    for line in page.lines:
        if found := _YEAR.search(line):
            year, months = int(found[1]), None
        elif year and (found := _MONTH.match(line)) and found[1].lower() in MONTHS:
            months = [MONTHS[m.lower()] for m in found.groups() if m and m.lower() in MONTHS]
        elif year and months and (found := _DAYS.match(line)):
            last = int(found[2] or found[1])
            # "Apr/May 30-1" ends in the second month; so does a span that goes back to small days.
            month = months[-1] if found[2] and int(found[2]) < int(found[1]) else months[0]
            if found[2] and int(found[2]) < int(found[1]) and len(months) == 1:
                month = month % 12 + 1
            out.add((dt.date(year, month, last), bool(found[3])))
            months = None
    return sorted(out)


def changes(old: list[dt.date], new: list[dt.date]) -> dict[str, list[dt.date]]:
    """Which meetings came and which went."""
    return {"added": sorted(set(new) - set(old)), "removed": sorted(set(old) - set(new))}
