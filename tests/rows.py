"""Rows and tables that several test modules share."""

from ebbtide.sources.schema import ALLOWED, CANONICAL

SF = "/root/testdata/sf0.001"


def customer(i=0, rng=None, **overrides):
    """One valid customer row, random if `rng` is given."""
    row = {"customer_id": f"C{i:05d}", "tenure_months": 24, "monthly_charges": 70.35,
           "total_charges": 1397.47, "churn": 0}
    for c in CANONICAL:
        if c in ALLOWED and c != "churn":
            row[c] = rng.choice(ALLOWED[c]) if rng else ALLOWED[c][0]
    if rng:
        row.update(tenure_months=rng.randrange(1, 72), monthly_charges=round(rng.uniform(20, 100), 2),
                   total_charges=round(rng.uniform(100, 5000), 2), churn=int(rng.random() < 0.3))
    return {**row, **overrides}
