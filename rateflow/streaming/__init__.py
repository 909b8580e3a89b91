from rateflow.streaming.incremental import arriving_pages, run_arrived

__all__ = ["arriving_pages", "run_arrived"]
