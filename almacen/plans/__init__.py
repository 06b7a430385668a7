"""Layer plans: silver, dimensions, facts, RFM, KPIs, and the stage runner."""
