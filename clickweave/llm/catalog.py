"""Queries of the operators over the given tables, and DuckDB SQL where it can express them."""

from __future__ import annotations

from clickweave.llm.align import op13_pointer_jumping
from clickweave.llm.chat import OP3_SQL, op3_snapshots
from clickweave.llm.decontaminate import OP10_SQL, op10_decontaminate
from clickweave.llm.epsgrid import OP5_SQL, op5_epsgrid
from clickweave.llm.html import op2_linedist
from clickweave.llm.merkle import OP12_SQL, op12_butterfly
from clickweave.llm.minhash import OP7_SQL, op7_minhash
from clickweave.llm.mix import OP6_SQL, op6_mix
from clickweave.llm.naming import OP11_SQL, op11_naming
from clickweave.llm.pii import op8_semicrf
from clickweave.llm.quality import op1_ordinal
from clickweave.llm.records import op9_records
from clickweave.llm.shard import op4_hilbert

QUERIES = {
    "op8_semicrf": op8_semicrf,
    "op1_ordinal": op1_ordinal,
    "op3_snapshots": op3_snapshots,
    "op2_linedist": op2_linedist,
    "op9_records": op9_records,
    "op4_hilbert": op4_hilbert,
    "op6_mix": op6_mix,
    "op5_epsgrid": op5_epsgrid,
    "op7_minhash": op7_minhash,
    "op10_decontaminate": op10_decontaminate,
    "op11_naming": op11_naming,
    "op12_butterfly": op12_butterfly,
    "op13_pointer_jumping": op13_pointer_jumping,
}

ORACLE = {
    "op3_snapshots": OP3_SQL,
    "op6_mix": OP6_SQL,
    "op5_epsgrid": OP5_SQL,
    "op7_minhash": OP7_SQL,
    "op10_decontaminate": OP10_SQL,
    "op11_naming": OP11_SQL,
    "op12_butterfly": OP12_SQL,
}
