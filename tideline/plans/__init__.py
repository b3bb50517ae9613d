from tideline.plans.config import LoadConfig
from tideline.plans.daily_load import DailyLoad
from tideline.plans.day_store import Conflict, DayStore
from tideline.plans.partitions import overwrite_days
from tideline.plans.versioned_load import VersionedLoad

__all__ = ["Conflict", "DailyLoad", "DayStore", "LoadConfig", "VersionedLoad", "overwrite_days"]
