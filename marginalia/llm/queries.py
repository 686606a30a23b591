"""Registered queries of this subpackage, with check statements where SQL can say them."""

from __future__ import annotations

from . import (
    chat, decontamination, hard_negatives, itq_dedup, language_id, mixing, near_dedup, nn_descent, pii, secrets, sharding, spelling, token_blocks)

QUERIES = {
    "op1_mixing": mixing.op1,
    "op2_language_id": language_id.op2,
    "op3_secrets": secrets.op3,
    "op4_near_dedup": near_dedup.op4,
    "op5_chat": chat.op5,
    "op6_decontamination": decontamination.op6,
    "op7_itq_dedup": itq_dedup.op7,
    "op8_pii": pii.op8,
    "op9_sharding": sharding.op9,
    "op10_token_blocks": token_blocks.op10,
    "op11_nn_descent": nn_descent.op11,
    "op12_hard_negatives": hard_negatives.op12,
    "op13_spelling": spelling.op13,
}

SQL: dict[str, str] = {
    "op1_mixing": mixing.SQL,
    "op3_secrets": secrets.SQL,
    "op5_chat": chat.SQL,
    "op7_itq_dedup": itq_dedup.SQL,
    "op8_pii": pii.SQL,
    "op9_sharding": sharding.SQL,
    "op11_nn_descent": nn_descent.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_spelling": spelling.SQL,
}
