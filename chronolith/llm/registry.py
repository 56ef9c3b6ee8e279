"""The operators' queries and their SQL, by name."""

from __future__ import annotations

from chronolith.llm import chat, collocations
from chronolith.llm import queries as q


def queries() -> dict:
    return {name: f for name, f in vars(q).items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op8_chat": chat.RENDER_SQL, "op11_collocations": collocations.MINED_SQL}
