from kpiloom.functions import dates, numbers, text, tickets

__all__ = ["dates", "numbers", "text", "tickets"]
