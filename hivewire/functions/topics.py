"""Topic names (P12), as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def reading_topic(building: Column, module: Column, publishing_topic: Column, device: Column) -> Column:
    return F.concat(F.lit("/"), building, F.lit("/"), module, F.lit("/"), publishing_topic, F.lit("/"), device)


def command_topic(module_path: Column) -> Column:
    return F.concat(module_path, F.lit(K.CMD_SUFFIX))


def register_topic(building: Column) -> Column:
    return F.concat(F.lit("/"), building, F.lit(K.REGISTER_SUFFIX))


def register_reply_topic(building: Column, device: Column) -> Column:
    return F.concat(F.lit("/"), building, F.lit(K.REGISTER_SUFFIX + "/"), device)


def kafka_topic(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix + "-"), key)
