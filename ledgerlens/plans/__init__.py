"""The batch job (J1), the registered queries with their oracle SQL, and the shared oracle CTEs."""
