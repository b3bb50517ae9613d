from tideline.functions.clock import gap_seconds, local_clock, local_time_fit, rolled_day, to_utc

__all__ = ["gap_seconds", "local_clock", "local_time_fit", "rolled_day", "to_utc"]
