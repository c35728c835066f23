"""DataFrame -> DataFrame datasets: silver, gold and quality reports."""
