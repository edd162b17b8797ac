"""Hiring-platform layouts."""

from gigloom.boards import (darwinbox, eightfold, freshteam, keka, lever, smartrecruiters, workable, workday, zoho)

BOARDS = {m.BOARD.name: m.BOARD for m in (
    darwinbox, freshteam, keka, lever, smartrecruiters, workable, zoho, eightfold, workday)}
