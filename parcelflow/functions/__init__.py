"""Column-expression helpers and the contract compiler."""
