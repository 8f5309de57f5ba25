"""Pure DataFrame operators. No operator runs an action except the guards
(``quality.require_rows``) and the iterative graph loops (one emptiness check per round)."""
