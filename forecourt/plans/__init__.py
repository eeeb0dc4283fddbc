"""Multi-step work: encoding, model ladder, search, scoring, reports."""
