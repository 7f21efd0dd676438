"""Reports, pricing, payroll, billing and audits for a legal-services business."""
