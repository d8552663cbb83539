"""The claims domain: staging, scope, economics, facts, dimensions, marts, reports, scenarios and checks."""
